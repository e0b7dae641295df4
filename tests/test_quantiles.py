"""Distributed exact quantiles equal NumPy's linear percentiles."""

import numpy as np
import pytest

from stockcast.functions.quantiles import exact_quantiles


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_grouped_quantiles_match_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(4):
        n = int(rng.integers(1, 300))
        vals = rng.normal(100, 30, size=n).round(2) if g % 2 else rng.integers(0, 5, size=n).astype(float)
        rows += [(f"g{g}", float(v)) for v in vals]
    rows += [("g0", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    qs = [0.25, 0.5, 0.75, 1 / 3]
    got = {r.g: r for r in exact_quantiles(df, "x", qs, by=["g"]).collect()}
    for g in got:
        vals = np.array([v for k, v in rows if k == g and v is not None])
        assert got[g].n == len(vals)
        for k, q in enumerate(qs):
            assert got[g][f"q{k}"] == pytest.approx(float(np.percentile(vals, q * 100)), rel=1e-12, abs=1e-9)


def test_global_quantiles_empty_and_single(spark):
    empty = spark.createDataFrame([], "x double")
    r = exact_quantiles(empty, "x", [0.5]).first()
    assert r.n == 0 and r.q0 is None
    one = spark.createDataFrame([(7.0,)], "x double")
    assert exact_quantiles(one, "x", [0.1, 0.9]).first().asDict() == {"n": 1, "q0": 7.0, "q1": 7.0}


def test_hot_value_is_one_row(spark):
    # a third of the rows share one value: still exact
    vals = [5.0] * 300 + [float(i) for i in range(600)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = exact_quantiles(df, "x", [1 / 3, 2 / 3]).first()
    assert r.q0 == pytest.approx(float(np.percentile(vals, 100 / 3)))
    assert r.q1 == pytest.approx(float(np.percentile(vals, 200 / 3)))


def test_describe_approx_close_to_exact(spark):
    from stockcast.operators.explore import describe_sales
    from stockcast.plans import registry as R
    c = R.clean(spark, "/root/testdata/sf0.001", R.PREDICT, R.SALES_COLS_RESTOCK)
    ex = {r.column: r for r in describe_sales(c).collect()}
    ap = {r.column: r for r in describe_sales(c, approx_accuracy=100000).collect()}
    for col in ex:
        assert ex[col]["count"] == ap[col]["count"]
        assert abs(ex[col].p50 - ap[col].p50) <= max(1.0, 0.01 * abs(ex[col].p50))


def test_no_cross_join_and_no_single_task(spark):
    from stockcast.functions.quantiles import exact_quantiles as eq
    df = spark.range(0, 50000, 1, 8).selectExpr("cast(id * 7 % 9973 as double) x")
    q = eq(df, "x", [0.25, 0.5])
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    vals = [float(i * 7 % 9973) for i in range(50000)]
    r = q.first()
    assert (r.q0, r.q1) == tuple(np.percentile(vals, [25, 50]))


def test_strict_edges_compare_all_four(spark):
    from stockcast.config import PREDICT
    from stockcast.operators.restock import with_priority
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate([1.0, 1.0, 1.0, 1.0, 2.0, 3.0, 4.0])], "StockCode string, recommended_restock double")
    with pytest.raises(ValueError, match="not unique"):
        with_priority(df, PREDICT.with_(strict_edges=True))
    assert with_priority(df, PREDICT).count() == 7
