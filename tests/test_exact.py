"""Order-independent sums: equal bits for every partitioning, and close to the true sum."""

import math
import random
import struct
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from stockcast.config import PREDICT
from stockcast.functions.exact import mean, pieces, total
from stockcast.operators import explore as EX
from stockcast.operators import restock as RS
from stockcast.operators.features import product_daily, with_lag_and_rolling
from stockcast.plans import registry as R


def bits(x):
    return x if x is None or not isinstance(x, float) else struct.pack(">d", x)


@pytest.mark.parametrize("wide", [False, True])
def test_sums_against_fractions(spark, wide):
    rng = random.Random(4)
    groups = {
        "money": [round(rng.uniform(0, 100), 2) for _ in range(2000)], "signs": [rng.uniform(-1, 1) for _ in range(2000)],
        "cancel": [1e15, 0.1, -1e15, 0.2, 2.0 ** -40, -0.3], "small": [-(2.0 ** -60), 2.0 ** -70], "negative": [-0.25, -7.75, 3.5],
        "one": [0.1], "zero": [0.0, -0.0], "large": [2.0 ** 60, 1.5, -(2.0 ** 59)]}
    rows = [(g, x) for g, xs in groups.items() for x in xs] + [("none", None), ("money", None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, x double")
    seen = set()
    for n in (1, 7, 211):
        got = {r.g: r for r in df.repartition(n).groupBy("g").agg(*pieces("x", F.col("x"), wide)).select(
            "g", total("x").alias("s"), mean("x").alias("m")).collect()}
        seen.add(tuple(sorted((g, bits(r.s), bits(r.m)) for g, r in got.items() if g != "none")))
        assert got["none"].s is None and got["none"].m is None
        for g, xs in groups.items():
            true = float(sum(map(Fraction, xs)))
            assert math.isclose(got[g].s, true, rel_tol=4e-16, abs_tol=2.0 ** -70), g
            assert math.isclose(got[g].m, true / len(xs), rel_tol=6e-16, abs_tol=2.0 ** -70)
    assert len(seen) == 1


def test_totals_beyond_64_bits_need_wide(spark):
    df = spark.range(10).select(F.lit(2.0 ** 62).alias("x"))
    assert df.agg(*pieces("x", F.col("x"), wide=True)).select(total("x")).first()[0] == 10 * 2.0 ** 62
    with pytest.raises(Exception, match="(?i)overflow"):
        df.agg(*pieces("x", F.col("x"))).select(total("x")).collect()


def test_features_stats_and_description_are_equal_to_the_bit(spark):
    clean = R.clean(spark, "/root/testdata/sf0.001", PREDICT, R.SALES_COLS_RESTOCK).withColumn("Price", F.col("Price") / 7).withColumn(
        "TotalPrice", F.col("TotalPrice") / 3).withColumn("Quantity", F.col("Quantity") * 1.1).cache()
    seen = {"daily": set(), "stats": set(), "profile": set(), "describe": set()}
    for n in (1, 7, 211):
        lines = clean.repartition(n)
        feats = with_lag_and_rolling(product_daily(lines))
        for name, df in (("daily", feats), ("stats", RS.product_stats(feats, 400)), ("profile", RS.product_profile(feats, PREDICT)),
                         ("describe", EX.describe_sales(lines))):
            seen[name].add(tuple(sorted(str([bits(v) for v in r]) for r in df.collect())))
    assert {name: len(s) for name, s in seen.items()} == dict.fromkeys(seen, 1)
