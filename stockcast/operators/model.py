"""Demand models (P11, M1-M7, A18, S12) with Spark ML.

Training reads the feature table once and writes the model columns to the
shared checkpoint folder, which lost executors do not take with them; each
regressor is a distributed Spark ML fit, and scoring is one batch
``transform`` over the whole forecast grid.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockcast.config import FEATURE_COLUMNS, SEED, TARGET_COLUMN
from stockcast.functions.materialize import materialize
from stockcast.operators.features import COPIES
from stockcast.operators.grid import fit_on_grid
from stockcast.operators.sample import train_test_split, train_test_split_exact

MODEL_ORDER = ("Linear Regression", "Random Forest", "Gradient Boosting")
ROWS_PER_TASK = 500_000  # training rows that one task of a tree fit takes, where there are more than two tasks a slot
CACHED_DEPTH = 5         # trees up to this depth are walked anew: that costs less than node ids written at each level


@dataclass(frozen=True)
class ModelSettings:
    rf_trees: int = 100
    rf_depth: int = 30          # the original grows unbounded trees; 30 is Spark's limit
    max_bins: int = 32          # split candidates per feature (Spark's default; the original tries all)
    gbt_rounds: int = 100
    gbt_depth: int = 3
    gbt_step: float = 0.1
    seed: int = SEED
    # execution only (same model): node ids cached between levels, node batch size
    # per task (None: sized from the heap and task slots, see tree_memory_mb)
    cache_node_ids: bool = True
    tree_memory_mb: int | None = None
    parallel_fits: int = 3      # models fitted concurrently (independent Spark jobs)
    exact_split: bool = False   # the original's counts to the row; else by buckets of the row's hash


def assembler() -> VectorAssembler:
    """The five features as one vector; a missing feature is an error, never a dropped row."""
    return VectorAssembler(inputCols=list(FEATURE_COLUMNS), outputCol="features", handleInvalid="error")


def tree_memory_mb(spark: SparkSession | None = None) -> int:
    """Node-statistics memory per task: half the heap spread over the task slots
    that share it (at most 1 GB, at least 16 MB): a small heap gets smaller node
    batches (more passes), never more than it holds."""
    try:
        sc = spark.sparkContext
        if sc.master.startswith("local"):
            heap_mb = sc._jvm.java.lang.Runtime.getRuntime().maxMemory() / 2 ** 20
            slots = sc.defaultParallelism
        else:
            conf = sc.getConf()
            heap_mb = _to_mb(conf.get("spark.executor.memory", "1g"))
            slots = int(conf.get("spark.executor.cores", "1"))
        return int(min(1024, max(16, heap_mb / (2 * max(1, slots)))))
    except Exception:  # noqa: BLE001
        return 256


def _to_mb(text: str) -> float:
    t = text.strip().lower()
    units = {"k": 1 / 1024, "m": 1, "g": 1024, "t": 1024 ** 2}
    if t[-1] == "b":
        t = t[:-1]
    return float(t[:-1]) * units[t[-1]] if t[-1] in units else float(t)  # bare number: MiB


def estimators(s: ModelSettings = ModelSettings(), spark: SparkSession | None = None, weight: str | None = None) -> dict:
    """M2-M4; ``weight``: the column that says how often a row counts."""
    label = TARGET_COLUMN
    mem = s.tree_memory_mb or tree_memory_mb(spark or SparkSession.getActiveSession())
    out = {
        "Linear Regression": LinearRegression(featuresCol="features", labelCol=label, solver="normal",
                                              regParam=0.0, fitIntercept=True),
        "Random Forest": RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=s.rf_trees,
                                               maxDepth=s.rf_depth, featureSubsetStrategy="all",
                                               seed=s.seed, cacheNodeIds=s.cache_node_ids,
                                               maxMemoryInMB=mem, maxBins=s.max_bins),
        "Gradient Boosting": GBTRegressor(featuresCol="features", labelCol=label, maxIter=s.gbt_rounds,
                                          maxDepth=s.gbt_depth, stepSize=s.gbt_step, seed=s.seed,
                                          cacheNodeIds=s.cache_node_ids and s.gbt_depth > CACHED_DEPTH,
                                          maxMemoryInMB=mem, maxBins=s.max_bins),
    }
    return {name: e.setWeightCol(weight) for name, e in out.items()} if weight else out


def model_frame(features: DataFrame) -> DataFrame:
    """The columns a model and its split need; every row is kept."""
    return features.select("StockCode", "Date", *FEATURE_COLUMNS, TARGET_COLUMN, *([COPIES] if COPIES in features.columns else []))


def regression_metrics(pred: DataFrame, label: str = TARGET_COLUMN, prediction: str = "prediction") -> DataFrame:
    """MSE, MAE, R^2 in one pass; sum((y - mean)^2) = var_pop(y) * n (stable).

    Rows count as often as ``COPIES`` says, where it is there.
    """
    e = F.col(label) - F.col(prediction)
    if COPIES in pred.columns:
        w, y = F.col(COPIES), F.col(label)
        mean = pred.agg(F.sum(w * y) / F.sum(w)).scalar()
        return pred.withColumn("_mean", mean).agg(
            (F.sum(w * e * e) / F.sum(w)).alias("mse"), (F.sum(w * F.abs(e)) / F.sum(w)).alias("mae"),
            (F.lit(1.0) - F.sum(w * e * e) / F.sum(w * (y - F.col("_mean")) * (y - F.col("_mean")))).alias("r2"), F.sum(w).alias("n"))
    return pred.agg(
        F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"),
        (F.lit(1.0) - F.sum(e * e) / (F.var_pop(label) * F.count(F.lit(1)))).alias("r2"),
        F.count(F.lit(1)).alias("n"),
    )


def model_base(features: DataFrame, seed: int = SEED, keys: bool = True, exact: bool = False) -> DataFrame:
    """M1 applied once: model columns + split, written once to the shared checkpoint folder.

    Dealt out by (StockCode, Date) over the session's shuffle partitions, which
    are sized to the data. Every fit reads this table; the tree learners keep
    their own binned copy of it. ``keys``: keep StockCode and Date.
    """
    n = int(features.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    split = train_test_split_exact if exact else train_test_split
    base = split(model_frame(features), seed).repartition(n, "StockCode", "Date")
    return materialize(base if keys else base.drop("StockCode", "Date"))


def split_frames(features: DataFrame, seed: int = SEED, keys: bool = True, exact: bool = False) -> tuple[DataFrame, DataFrame]:
    """M1 applied: (train, test) over one materialized frame; nothing stays cached."""
    base = model_base(features, seed, keys, exact)
    return (base.where(F.col("split") == "train").drop("split"),
            base.where(F.col("split") == "test").drop("split"))


def tree_input(train: DataFrame) -> DataFrame:
    """The training rows in as many partitions as the task slots and their number ask for, at most those they have.

    At each level of a forest every partition sends its statistics of all open
    nodes, and a boosting of 100 rounds starts its tasks some 400 times: more
    partitions than that cost time and shuffled bytes that do not depend on the rows.
    """
    slots = train.sparkSession.sparkContext.defaultParallelism
    return train.coalesce(max(2 * slots, -(-train.count() // ROWS_PER_TASK)))


def fit(name: str, train: DataFrame, settings: ModelSettings = ModelSettings()) -> PipelineModel:
    """M2-M4: one regressor behind the assembler; trees over many rows are grown on a grid of feature bins."""
    weight = COPIES if COPIES in train.columns else None
    regressor = estimators(settings, train.sparkSession, weight)[name]
    if name != "Linear Regression":
        train = tree_input(train)
        if model := fit_on_grid(regressor, train, weight):
            return PipelineModel([assembler(), model])
    return Pipeline(stages=[assembler(), regressor]).fit(train)


def predictions(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """``transform``; for a forest the rows are sorted within their partitions first, so that neighbours
    take the same ways through its trees, which are more than a processor's cache holds."""
    if isinstance(model.stages[-1], RandomForestRegressionModel):
        rows = rows.sortWithinPartitions(*FEATURE_COLUMNS)
    return model.transform(rows)


def compare_models(features: DataFrame, settings: ModelSettings = ModelSettings(),
                   names=MODEL_ORDER) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """M5: fit each model on the train part, A18 on the test part -> one row per model."""
    spark = features.sparkSession
    train, test = split_frames(features, settings.seed, keys=False, exact=settings.exact_split)

    def one(pos_name):
        pos, name = pos_name
        m = fit(name, train, settings)
        r = regression_metrics(predictions(m, test)).first()
        return name, m, (name, pos, float(r["mse"]), float(r["mae"]), float(r["r2"]), int(r["n"]))

    # independent fits run as concurrent Spark jobs; only 3 metric rows come back
    with ThreadPoolExecutor(max_workers=max(1, settings.parallel_fits)) as pool:
        done = list(pool.map(one, enumerate(names)))
    models = {name: m for name, m, _ in done}
    rows = [row for _, _, row in done]
    result = spark.createDataFrame(rows, "model string, position int, mse double, mae double, r2 double, n long")
    return result, models


def best_model(results: DataFrame) -> DataFrame:
    """M6: highest R^2, the first model on ties."""
    return results.orderBy(F.col("r2").desc(), F.col("position")).limit(1)


def model_scorer(model: PipelineModel):
    """M7: a scorer for the forecast grid (adds ``prediction``)."""
    def score(grid: DataFrame) -> DataFrame:
        return model.transform(grid).drop("features")
    return score


def save_model(model: PipelineModel, path: str) -> str:
    """Persist the chosen model (overwrites)."""
    model.write().overwrite().save(path)
    return path


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    """Reload; a clear error when nothing was saved there."""
    try:
        return PipelineModel.load(path)
    except Exception as e:  # noqa: BLE001
        raise FileNotFoundError(f"no saved model at {path}; run training first") from e
