"""Plan shape: the properties the design relies on at scale, read from explain()."""

from pyspark.sql import functions as F

from stockcast.config import PREDICT
from stockcast.functions.materialize import materialize
from stockcast.operators import report as RP
from stockcast.operators import restock as RS
from stockcast.plans import registry as R
from stockcast.session import scale_settings
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _main_plan(df) -> str:
    """The physical plan with exchanges, planned with AQE off for a stable text."""
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_features_need_two_exchanges_and_prune_columns(spark):
    f = R.features(spark, SF_SMALL, PREDICT)
    plan = _main_plan(f)
    assert plan.count("Exchange") == 2
    assert "hashpartitioning(StockCode" in plan
    scan = [line for line in plan.splitlines() if "FileScan" in line][0]
    for unused in ("l_suppkey", "l_tax", "l_discount"):
        assert unused not in scan


def test_per_product_steps_reuse_the_window_partitioning(spark):
    f = materialize(R.features(spark, SF_SMALL, PREDICT), "checkpoint")
    nums = RS.restock_numbers(f, PREDICT, RS.baseline_scorer)
    main = _main_plan(nums).split("Subquery")[0]
    assert "Exchange" not in main
    assert "Generate explode" in main


def test_stratified_top_k_limits_before_the_exchange(spark):
    res = spark.range(1000).select(F.col("id").cast("string").alias("StockCode"),
                                   (F.col("id") % 97).cast("double").alias("recommended_restock"),
                                   F.when(F.col("id") % 3 == 0, "High").otherwise("Low").alias("priority"))
    plan = _plan(RP.restock_by_priority(res, (5, 4, 3), fallback=None))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_scale_settings():
    s = scale_settings(100 * 1024 ** 4, 8000)
    assert int(s["spark.sql.shuffle.partitions"]) > 100_000
    assert s["spark.sql.adaptive.skewJoin.enabled"] == "true"
    small = scale_settings(10 * 1024 ** 2, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16


def _line_scans(df) -> int:
    """lineitem scans anywhere in the plan, subqueries included (materialized inputs count none)."""
    return _plan(df).count("lineitem.parquet")


def test_step_and_report_queries_do_not_scan_the_lines_again(spark):
    # the one scan is the materialization that ran while the query was built
    for name in ("estimated_cost", "report_picks", "prompt_table", "score", "forecast_grid"):
        assert _line_scans(R.QUERIES[name](spark, SF_SMALL)) == 0, name
    shape = _plan(R.QUERIES["dataset_shape"](spark, SF_SMALL))
    assert "Join" not in shape and shape.count(".parquet") == 1
