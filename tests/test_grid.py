"""Trees grown on the grid of feature bins, held against Spark ML's learners on the same rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockcast.operators import grid as G
from stockcast.operators import model as MD
from stockcast.operators.features import COPIES
from stockcast.operators.nodes import node_table, tree_scores

SETTINGS = MD.ModelSettings(rf_trees=12, rf_depth=6, gbt_rounds=8)


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(7)
    made = []
    for i in range(3000):
        lag, rolling, month, day, weekday = r.randint(-20, 90), r.randint(0, 400) / 7, r.randint(1, 12), r.randint(1, 28), r.randint(0, 6)
        made.append((i, float(lag), rolling, month, day, weekday, round(rolling + lag * (month > 6) + r.gauss(0, 9), 2), r.randint(1, 3)))
    return spark.createDataFrame(made, f"i int, Lag1_Quantity double, Rolling7_Quantity double, Month int, Day int, DayOfWeek int, Quantity double, {COPIES} long")


@pytest.fixture()
def on_grid(monkeypatch):
    monkeypatch.setattr(G, "GRID_ROWS", 0)


def _said(model, rows):
    return np.array([r.prediction for r in model.transform(rows).orderBy("i").select("prediction").collect()])


def _splits(model):
    return [line for line in model.stages[-1].trees[0].toDebugString.split("\n") if "(feature" in line]


def test_boosting_is_that_of_spark_ml(rows, monkeypatch):
    for train in (rows.drop(COPIES), rows):  # with and without weights
        theirs = MD.fit("Gradient Boosting", train, SETTINGS)
        with monkeypatch.context() as m:
            m.setattr(G, "GRID_ROWS", 0)
            ours = MD.fit("Gradient Boosting", train, SETTINGS)
        assert ours.stages[-1].treeWeights == theirs.stages[-1].treeWeights and ours.stages[-1].getMaxDepth() == 3
        np.testing.assert_allclose(_said(ours, rows), _said(theirs, rows), rtol=1e-9)
        assert _splits(ours) == _splits(theirs)


def test_sampled_split_candidates_are_those_of_spark_ml(spark, monkeypatch):
    # more rows than the 10,000 from which the candidates are taken
    rows = spark.range(0, 30_000, 1, 5).selectExpr(
        "cast(id as int) as i", "cast(hash(id) % 97 as double) as Lag1_Quantity", "(hash(id, 1) % 1000) / 7D as Rolling7_Quantity", "cast(abs(hash(id, 2)) % 12 + 1 as int) as Month",
        "cast(abs(hash(id, 3)) % 28 + 1 as int) as Day", "cast(abs(hash(id, 4)) % 7 as int) as DayOfWeek").withColumn("Quantity", F.expr("Lag1_Quantity * Month + Rolling7_Quantity * DayOfWeek"))
    settings = MD.ModelSettings(gbt_rounds=1, gbt_depth=6)
    theirs = MD.fit("Gradient Boosting", rows, settings)
    monkeypatch.setattr(G, "GRID_ROWS", 20_000)
    ours = MD.fit("Gradient Boosting", rows, settings)
    assert _splits(ours) == _splits(theirs)


def test_forest_on_the_grid(spark, rows, on_grid, tmpdir_path):
    train = rows.drop(COPIES)
    forest = MD.fit("Random Forest", train, SETTINGS)
    trees = forest.stages[-1].trees
    assert len(trees) == 12 and all(t.depth == 6 for t in trees) and len({t.toDebugString.split("\n", 1)[1] for t in trees}) == 12
    assert MD.regression_metrics(MD.predictions(forest, train)).first()["r2"] > 0.8
    # bags of 3000 rows with replacement, by the stats of the roots
    table = node_table(spark, forest, f"{tmpdir_path}/forest")
    saved = spark.read.parquet(f"{tmpdir_path}/forest/stages/1_{forest.stages[-1].uid}/data")
    bags = [r.n for r in saved.where("nodeData.id = 0").selectExpr("nodeData.rawCount as n").collect()]
    assert len(set(bags)) > 6 and all(abs(n - 3000) < 5 * 3000 ** 0.5 for n in bags)
    ours = {r.i: r.prediction for r in tree_scores(train, ["i"], table).collect()}
    np.testing.assert_allclose([ours[i] for i in range(3000)], _said(forest, train), rtol=1e-9)
    # neither partitions nor the order of rows change it
    again = MD.fit("Random Forest", train.repartition(7, "Day").orderBy(F.desc("i")), SETTINGS)
    np.testing.assert_allclose(_said(again, train), _said(forest, train), rtol=1e-9)


def test_forest_is_as_good_as_that_of_spark_ml(rows, monkeypatch):
    train, test = rows.where("i % 5 > 0"), rows.where("i % 5 = 0")
    theirs = MD.regression_metrics(MD.fit("Random Forest", train, SETTINGS).transform(test)).first()["r2"]
    monkeypatch.setattr(G, "GRID_ROWS", 0)
    ours = MD.regression_metrics(MD.fit("Random Forest", train, SETTINGS).transform(test)).first()["r2"]
    assert abs(ours - theirs) < 0.02


def test_draws_are_poisson_and_do_not_depend_on_the_calls():
    n = np.array([1, 1, 3, 40, 1, 8, 9] * 300)
    whole = G.Draws(42, 5).times(n, 20)
    parts = G.Draws(42, 5)
    assert (whole == np.concatenate([parts.times(n[:11], 20), parts.times(n[11:1000], 20), parts.times(n[1000:], 20)])).all()
    assert (whole != G.Draws(42, 6).times(n, 20)).any()
    for value in (1, 3, 8, 9, 40):
        drawn = whole[n == value]
        assert abs(drawn.mean() - value) < 5 * (value / drawn.size) ** 0.5 and abs(drawn.var() / value - 1) < 0.15
    ones = np.bincount(whole[n == 1].ravel().astype(int), minlength=3) / whole[n == 1].size
    assert abs(ones[0] - np.exp(-1)) < 0.02 and abs(ones[1] - np.exp(-1)) < 0.02 and abs(ones[2] - np.exp(-1) / 2) < 0.02


def test_equal_rows_count_one_by_one(rows, on_grid):
    train = rows.drop(COPIES)
    once, twice = (MD.fit("Gradient Boosting", t, SETTINGS) for t in (train, train.unionAll(train)))
    np.testing.assert_allclose(_said(once, train), _said(twice, train), rtol=1e-9)
    weighted = MD.fit("Gradient Boosting", train.withColumn(COPIES, F.lit(2).cast("long")), SETTINGS)
    np.testing.assert_allclose(_said(weighted, train), _said(twice, train), rtol=1e-9)


@pytest.mark.parametrize("bad", ["cast(null as double)", "double('NaN')"])
def test_missing_values_are_errors(rows, on_grid, bad):
    for column in ("Lag1_Quantity", "Quantity"):
        with pytest.raises(Exception, match="(?i)null|nan"):
            MD.fit("Random Forest", rows.withColumn(column, F.when(F.col("i") == 5, F.expr(bad)).otherwise(F.col(column))), SETTINGS)


def test_few_rows_and_wide_grids_are_left_to_spark_ml(spark, rows, monkeypatch):
    forest = MD.estimators(SETTINGS, spark)["Random Forest"]
    assert G.fit_on_grid(forest, rows) is None
    monkeypatch.setattr(G, "GRID_ROWS", 0)
    monkeypatch.setattr(G, "GRID_CELLS", 1000)
    assert G.fit_on_grid(forest, rows) is None


def test_a_constant_target_and_constant_features(spark, on_grid):
    rows = spark.range(50).selectExpr("cast(id as int) as i", "id * 1.0D as Lag1_Quantity", "0.0D as Rolling7_Quantity", "1 as Month", "2 as Day", "0 as DayOfWeek", "5.0D as Quantity")
    for name in MD.MODEL_ORDER[1:]:
        assert set(_said(MD.fit(name, rows, SETTINGS), rows)) == {5.0}


def _compared(spark, rows, monkeypatch):
    """compare_models over many days of a few products, with the names of the learners that ran on the grid."""
    seen = []
    grown = MD.fit_on_grid
    monkeypatch.setattr(MD, "fit_on_grid", lambda est, *a: [m := grown(est, *a), seen.append((type(est).__name__, m is not None))][0])
    features = rows.withColumn("StockCode", F.concat(F.lit("P"), F.col("i") % 9)).withColumn("Date", F.date_add(F.lit("2020-01-01").cast("date"), F.col("i")))
    return MD.compare_models(features.drop(COPIES), MD.ModelSettings(rf_trees=4, rf_depth=5, gbt_rounds=4))[0], seen


def test_compare_models_grows_both_tree_models_on_the_grid(spark, rows, monkeypatch):
    theirs, seen = _compared(spark, rows, monkeypatch)
    assert sorted(seen) == [("GBTRegressor", False), ("RandomForestRegressor", False)]
    monkeypatch.setattr(G, "GRID_ROWS", 0)
    ours, seen = _compared(spark, rows, monkeypatch)
    assert ("GBTRegressor", True) in seen and ("RandomForestRegressor", True) in seen
    a, b = ({r.model: r for r in x.collect()} for x in (theirs, ours))
    assert a.keys() == b.keys() == set(MD.MODEL_ORDER) and {r.n for r in b.values()} == {r.n for r in a.values()}
    for name in ("Linear Regression", "Gradient Boosting"):
        assert abs(a[name].mse - b[name].mse) < 1e-9 and abs(a[name].r2 - b[name].r2) < 1e-9
    assert abs(a["Random Forest"].r2 - b["Random Forest"].r2) < 0.05


def test_best_model_of_grid_fits_is_the_highest_r2(spark, rows, on_grid, monkeypatch):
    metrics, seen = _compared(spark, rows, monkeypatch)
    best = max(metrics.collect(), key=lambda r: (r.r2, -r.position)).model
    assert len(seen) == 2 and MD.best_model(metrics).first().model == best
