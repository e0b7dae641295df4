"""Fitted trees as a table of nodes, and scoring rows by joins against it.

The table says what a model is, independent of the library that fitted it: one
row per node with the feature and threshold it splits on, its children and its
value, and one weight per tree. A row starts at node 0 of every tree and goes
one level down per join on (tree, node); rows that reach a leaf leave with its
value, so each join only carries those still on their way. ``tree_scores`` sums
weight x value per row: the mean over a forest's trees, the sum over the rounds
of boosting.

The node table has at most trees x 2**(depth + 1) rows and is joined by key, not
collected; Spark broadcasts it where its size allows.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockcast.config import FEATURE_COLUMNS
from stockcast.functions.materialize import materialize
from stockcast.operators.model import save_model


def node_table(spark: SparkSession, model: PipelineModel, path: str) -> DataFrame:
    """tree, node, feature (NULL in a leaf), threshold, left, right, value, weight.

    The model is saved under ``path`` and its node data read back from there.
    """
    save_model(model, path)
    regressor = model.stages[-1]
    stage = f"{path}/stages/{len(model.stages) - 1}_{regressor.uid}"
    weights = list(regressor.treeWeights)
    if type(regressor).__name__.startswith("RandomForest"):
        weights = [w / sum(weights) for w in weights]
    tree_weight = spark.createDataFrame(list(enumerate(weights)), "tree int, weight double")  # a row per tree
    data = spark.read.parquet(f"{stage}/data")
    node = F.col("nodeData")
    leaf = node["leftChild"] < 0
    return data.select(
        F.col("treeID").alias("tree"), node["id"].alias("node"), F.when(~leaf, node["split"]["featureIndex"]).alias("feature"),
        F.when(~leaf, node["split"]["leftCategoriesOrThreshold"][0]).alias("threshold"), F.when(~leaf, node["leftChild"]).alias("left"),
        F.when(~leaf, node["rightChild"]).alias("right"), node["prediction"].alias("value")).join(tree_weight, "tree")


def tree_scores(rows: DataFrame, key: list[str], nodes: DataFrame, levels_at_once: int = 4) -> DataFrame:
    """``key`` and ``prediction`` of every row, by level-wise joins against ``nodes``; ``key`` names a row."""
    x = F.array(*[F.col(c).cast("double") for c in FEATURE_COLUMNS])
    trees = nodes.where("node = 0").select("tree", "node")
    # every tree's root for every row: as many rows as there are votes
    tree_list = [r["tree"] for r in trees.select("tree").distinct().collect()]
    at = rows.select(*key, x.alias("x")).withColumn("tree", F.explode(F.array(*map(F.lit, sorted(tree_list))))).withColumn("node", F.lit(0))
    votes, level = None, 0
    while True:
        here = at.join(nodes, ["tree", "node"])
        done = here.where("feature is null").select(*key, (F.col("weight") * F.col("value")).alias("vote"))
        votes = done if votes is None else votes.unionByName(done)
        go_left = F.element_at("x", F.col("feature") + 1) <= F.col("threshold")
        at = here.where("feature is not null").select(*key, "x", "tree", F.when(go_left, F.col("left")).otherwise(F.col("right")).alias("node"))
        level += 1
        if level % levels_at_once == 0:  # the plan is cut before it grows with the depth
            at, votes = materialize(at), materialize(votes)
            if at.isEmpty():
                break
    return votes.groupBy(*key).agg(F.sum("vote").alias("prediction"))
