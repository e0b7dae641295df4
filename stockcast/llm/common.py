"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

from stockcast.functions.materialize import materialize
from stockcast.session import ensure_checkpoint_dir

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()

#: Rows of one Arrow batch between Spark and its Python workers: rows may be whole long texts.
ARROW_ROWS = 1000
_ARROW_ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Give executors this package (once per application), so that tasks can import it.

    Functions of importable modules are pickled by name, which also keeps the
    word tables of a Python worker alive between its tasks. A session that has
    Spark's default of 10,000 rows a batch gets ``ARROW_ROWS`` instead.
    """
    sc: SparkContext = spark.sparkContext
    if spark.conf.get(_ARROW_ROWS_KEY) == "10000":
        spark.conf.set(_ARROW_ROWS_KEY, str(ARROW_ROWS))
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(_PACKAGE)
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="stockcast-code-")), "stockcast_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(_PACKAGE):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder; later reads start from there."""
    return materialize(df, "checkpoint")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors and the driver share, as a URI without a trailing slash."""
    path = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    return (path if "://" in path else "file://" + os.path.abspath(path)).rstrip("/")


def slices(spark: SparkSession) -> int:
    """Parallelism to deal rows out to: the session's shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
