"""Properties from the test plan: sampling and split do not depend on partitioning."""

import pytest

from stockcast.operators.sample import sample_rows, train_test_split
from stockcast.plans import registry as R
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_sample_is_partition_independent(spark, parts):
    sales = R.source(spark, SF_SMALL).sales()
    base = sorted(map(tuple, sample_rows(sales, 50).collect()), key=str)
    other = sorted(map(tuple, sample_rows(sales.repartition(parts), 50).collect()), key=str)
    assert base == other and len(base) == 50


def test_sample_keeps_all_rows_when_small(spark, f1):
    assert sample_rows(f1, 500).count() == f1.count()


@pytest.mark.parametrize("parts", [2, 5])
def test_split_is_partition_independent(spark, parts):
    f = R.features(spark, SF_SMALL, R.TRAINING).select("StockCode", "Date", "Quantity")
    a = {(r.StockCode, r.Date): r.split for r in train_test_split(f).collect()}
    b = {(r.StockCode, r.Date): r.split for r in train_test_split(f.repartition(parts)).collect()}
    assert a == b
    share = sum(v == "train" for v in a.values()) / len(a)
    assert 0.7 < share < 0.9
