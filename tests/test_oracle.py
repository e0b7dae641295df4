"""Spark queries against their DuckDB text at sf0.001 (the full list runs in tools_check.py)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

SUBSET = ["clean_sales", "product_daily", "features_predict", "features_training",
          "restock_recommendations", "restock_training", "priority_tertiles", "priority_summary",
          "restock_by_priority", "describe_sales", "sample_rows", "regression_metrics", "dashboard_records",
          "product_text", "linear_regression", "linear_metrics", "score", "awkward_round_trip", "csv_first_description",
          "by_priority_round_trip", "write_restock_round_trip", "fanout_descriptions", "malformed_lines"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("lineitem", "orders", "customer", "nation", "part"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _rows(rows):
    def k(r):
        return tuple((0, "") if v is None else (1, str(v)) for v in r)
    return sorted(rows, key=k)


@pytest.mark.parametrize("name", [n for n in SUBSET if n in E.queries()])
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = _rows([tuple(r[c] for c in cols) for r in df.collect()])
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    exp = _rows([tuple(r[i] for i in idx) for r in rel.fetchall()])
    assert len(got) == len(exp)
    for a, b in zip(got, exp):
        for x, y in zip(a, b):
            if isinstance(x, float) and isinstance(y, float):
                assert (math.isnan(x) and math.isnan(y)) or x == y
            else:
                assert x == y


def test_every_query_has_a_callable_and_oracles_have_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    from stockcast.plans.registry import QUERIES
    rows_only = set(QUERIES) - set(E.oracle_sql())
    assert rows_only == {"random_forest", "gradient_boosting", "compare_models", "best_model"}


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["StockCode", "predicted_weekly_demand", "safety_stock", "recommended_restock",
                          "avg_price", "estimated_cost", "Description", "priority"]
