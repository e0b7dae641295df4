"""Forest and boosting held against their node tables: every test row, and the metrics."""

import math

import pytest

from stockcast.config import TARGET_COLUMN
from stockcast.operators import model as MD
from stockcast.operators.nodes import node_table, tree_scores
from stockcast.plans import registry as R

SETTINGS = MD.ModelSettings(rf_trees=5, rf_depth=6, gbt_rounds=5)


@pytest.fixture(scope="module")
def frames(spark):
    return MD.split_frames(R.features(spark, "/root/testdata/sf0.001", R.TRAINING), exact=True)


@pytest.mark.parametrize("name", ["Random Forest", "Gradient Boosting"])
def test_level_wise_joins_score_every_row_as_transform_does(spark, frames, tmpdir_path, name):
    train, test = frames
    model = MD.fit(name, train, SETTINGS)
    nodes = node_table(spark, model, f"{tmpdir_path}/model")
    leaves = nodes.where("feature is null")
    assert nodes.select("tree").distinct().count() == 5 and leaves.where("left is not null").count() == 0
    key = ["StockCode", "Date"]
    ours = tree_scores(test, key, nodes)
    theirs = model.transform(test).select(*key, "prediction")
    got, want = ({(r.StockCode, r.Date): r.prediction for r in df.collect()} for df in (ours, theirs))
    assert got.keys() == want.keys() and len(got) == test.count() > 300
    assert all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)
    again = MD.regression_metrics(test.join(ours, key)).first()
    assert all(math.isclose(a, b, rel_tol=1e-9) for a, b in zip(again, MD.regression_metrics(model.transform(test)).first(), strict=True))


def test_the_winner_is_that_of_recomputed_metrics(spark, frames, tmpdir_path):
    train, test = frames
    key, found = ["StockCode", "Date"], {}
    for name in ("Random Forest", "Gradient Boosting"):
        nodes = node_table(spark, MD.fit(name, train, SETTINGS), f"{tmpdir_path}/{name[:2]}")
        found[name] = MD.regression_metrics(test.join(tree_scores(test, key, nodes), key)).first()["r2"]
    mean = test.agg({TARGET_COLUMN: "avg"}).first()[0]
    base = test.selectExpr(f"avg(pow({TARGET_COLUMN} - {mean}, 2)) as v").first()["v"]
    assert base > 0 and all(r2 > -1 for r2 in found.values())
    features = R.features(spark, "/root/testdata/sf0.001", R.TRAINING)
    metrics, _ = MD.compare_models(features, MD.ModelSettings(rf_trees=5, rf_depth=6, gbt_rounds=5, exact_split=True), names=MD.MODEL_ORDER[1:])
    want = max(found, key=found.get)
    assert MD.best_model(metrics).first()["model"] == want
