"""Cutting lineage between the heavy part of a plan and its re-reads.

Scalar subqueries (latest date, quantile edges) re-run their input plan. The
input is written once instead: ``checkpoint`` stores it in the shared folder
named by ``spark.checkpoint.dir`` (survives lost executors and keeps the
partitioning, so later per-product steps still need no exchange);
``persist`` keeps it in executor memory and disk (recomputed when lost);
``none`` leaves the plan as it is.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from stockcast.session import ensure_checkpoint_dir


def materialize(df: DataFrame, how: str = "checkpoint") -> DataFrame:
    if how == "none":
        return df
    if how == "persist":
        out = df.persist(StorageLevel.MEMORY_AND_DISK)
        out.count()
        return out
    if how == "checkpoint":
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    raise ValueError(f"unknown materialize mode: {how}")
