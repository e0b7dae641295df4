"""Models: fit, compare, save and load, and the predict job with a saved model."""

from pyspark.sql import functions as F

from stockcast.config import PREDICT, TRAINING
from stockcast.operators import model as MD
from stockcast.operators.clean import clean_sales
from stockcast.operators.features import engineer_features
from stockcast.plans import jobs
from stockcast.sources.star import StarSales
from tests.conftest import SF_SMALL

SMALL = MD.ModelSettings(rf_trees=5, rf_depth=4, gbt_rounds=5)


def test_compare_save_load_predict(spark, tmpdir_path):
    src = StarSales(spark, SF_SMALL)
    res = jobs.train(spark, src, out_dir=tmpdir_path, settings=SMALL)
    m = {r.model: r for r in res.metrics.collect()}
    assert set(m) == set(MD.MODEL_ORDER)
    assert all(r.mse >= 0 and r.mae >= 0 for r in m.values())
    assert res.best == max(m.values(), key=lambda r: (r.r2, -r.position)).model
    out = jobs.predict(spark, src, res.model_path, out_dir=tmpdir_path, detailed=True)
    rows = out.collect()
    assert len(rows) > 0 and {r.priority for r in rows} <= {"Low", "Medium", "High", None}


def test_metrics_formula(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 4.0)], "Quantity double, prediction double")
    r = MD.regression_metrics(df).first()
    assert abs(r.mse - 2 / 3) < 1e-12 and abs(r.mae - 2 / 3) < 1e-12 and abs(r.r2 - (1 - 2 / 8)) < 1e-12


def test_load_missing_model(spark, tmpdir_path):
    import pytest
    with pytest.raises(FileNotFoundError):
        MD.load_model(spark, f"{tmpdir_path}/nothing")


def test_reports_and_console(spark, tmpdir_path):
    import os

    from stockcast.plans import registry as R
    res = R.restock(spark, SF_SMALL, PREDICT)
    paths = jobs.save_reports(res, R.features(spark, SF_SMALL, PREDICT), f"{tmpdir_path}/rep")
    assert all(os.path.exists(os.path.join(p, "_SUCCESS")) for p in paths.values())
    tables = jobs.console_tables(res)
    rows = tables["by_priority"].collect()
    assert len(rows) <= 15 and all(len(r.Description) >= 37 for r in rows)
    assert [r.priority for r in tables["summary"].collect()] == ["High", "Medium", "Low"]


def test_tree_memory_sizing(spark):
    assert MD._to_mb("4g") == 4096 and MD._to_mb("512m") == 512 and MD._to_mb("1024") == 1024
    heap_mb = spark.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory() / 2 ** 20
    mem = MD.tree_memory_mb(spark)
    assert 16 <= mem <= 1024
    assert mem * spark.sparkContext.defaultParallelism <= max(heap_mb / 2, 16 * spark.sparkContext.defaultParallelism) + 1


def test_missing_feature_is_an_error(spark):
    import pytest
    train = spark.createDataFrame([(1.0, 2.0, 3, 4, 5, 6.0), (None, 2.0, 3, 4, 5, 6.0)],
                                  "Lag1_Quantity double, Rolling7_Quantity double, Month int, Day int, DayOfWeek int, Quantity double")
    with pytest.raises(Exception, match="(?i)null"):
        MD.fit("Linear Regression", train)


def test_tree_memory_does_not_change_the_model(spark):
    from stockcast.plans import registry as R
    train, test = MD.split_frames(R.features(spark, SF_SMALL, TRAINING))
    got = [MD.fit("Random Forest", train, MD.ModelSettings(rf_trees=4, rf_depth=6, tree_memory_mb=mb)).transform(test)
           .agg(F.sum("prediction")).first()[0] for mb in (1, 256)]
    assert abs(got[0] - got[1]) < 1e-6


def test_tree_models_beat_the_mean(spark):
    from stockcast.plans import registry as R
    r = {x.model: x for x in MD.compare_models(R.features(spark, "/root/testdata/sf0.01", TRAINING),
                                               MD.ModelSettings(rf_trees=10, rf_depth=6, gbt_rounds=10))[0].collect()}
    assert r["Random Forest"].r2 > 0.1 and r["Gradient Boosting"].r2 > 0.1


def test_command_line_writes_every_table(spark, tmpdir_path, monkeypatch):
    import os

    from stockcast import __main__ as cli
    monkeypatch.setattr(cli, "local_session", lambda app: spark)
    out = f"{tmpdir_path}/cli"
    cli.main(["train", "--star", SF_SMALL, "--out", out, "--trees", "3", "--rf_depth", "4"])
    cli.main(["predict", "--star", SF_SMALL, "--model_path", f"{out}/models/demand_model", "--out", out, "--detailed_output"])
    cli.main(["report", "--star", SF_SMALL, "--model_path", f"{out}/models/demand_model", "--out", out])
    done = {os.path.relpath(d, out) for d, _, names in os.walk(out) if "_SUCCESS" in names}
    want = {"checks/columns", "checks/shape", "checks/malformed_invoices", "predictions/restock", "predictions/by_priority",
            "predictions/summary", "reports/restock_recommendations", "reports/short_markdown", "reports/short_html", "reports/tables", "reports/prompts",
            "reports/picks", *(f"exploration/{x}" for x in ("describe", "top_products", "sales_by_country", "monthly_sales", "weekday_sales"))}
    assert want <= done


def test_tree_fits_run_few_tasks_over_all_rows(spark, monkeypatch):
    train = spark.range(400).repartition(60)
    slots = spark.sparkContext.defaultParallelism
    few = MD.tree_input(train)
    assert few.rdd.getNumPartitions() == 2 * slots and few.count() == few.distinct().count() == 400
    monkeypatch.setattr(MD, "ROWS_PER_TASK", 10)  # more rows, more partitions
    assert MD.tree_input(train).rdd.getNumPartitions() == max(2 * slots, 40)
    seen = []
    monkeypatch.setattr(MD, "tree_input", lambda df: seen.append(df) or df)
    rows = spark.range(50).selectExpr("id * 1.0D as Lag1_Quantity", "id * 2.0D as Rolling7_Quantity", "1 as Month", "2 as Day", "3 as DayOfWeek", "id * 3.0D as Quantity")
    for name in MD.MODEL_ORDER:
        MD.fit(name, rows, MD.ModelSettings(rf_trees=1, rf_depth=2, gbt_rounds=1))
    assert len(seen) == 2


def test_shallow_trees_keep_no_node_ids(spark):
    made = MD.estimators(MD.ModelSettings(), spark)
    assert made["Random Forest"].getCacheNodeIds() and not made["Gradient Boosting"].getCacheNodeIds()
