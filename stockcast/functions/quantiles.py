"""Exact quantiles per group without gathering a column into one task.

For whole columns see ``selection``, which the tertile edges here use. With
groups, of which there may be any number, the order statistics x[r] (0-based, NULLs removed) of each group are found by
counting over range-partitioned distinct values:

1. distinct (group, value) pairs with their counts (partial aggregation),
2. range-partitioned by (group, value) over the normal shuffle partitions and
   written once with the number of their partition,
3. totals per (group, partition), running offsets over them,
4. only the partitions that hold a wanted rank are read again; a running count
   inside them plus their offset gives x[r].

No task holds more than one range partition or one total per partition; a hot
value is one row after step 1, whatever its count. There is one path for every
size. The interpolation between x[i] and x[i+1] is NumPy's two-sided linear
form, so results equal pandas; ``pandas_scaled`` reproduces how pandas passes
q through percent (q*100/100), which decides tertile ties.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockcast.functions.materialize import materialize
from stockcast.functions.selection import select


def _q_scaled(q: float, pandas_scaled: bool) -> float:
    return (q * 100) / 100 if pandas_scaled else q


def _lerp(lo: Column, hi: Column, g: Column) -> Column:
    return F.when(g >= 0.5, hi - (hi - lo) * (1 - g)).otherwise(lo + (hi - lo) * g)


def _ranks(q: float, pandas_scaled: bool) -> tuple[Column, Column, Column]:
    p = (F.col("n") - 1).cast("double") * F.lit(_q_scaled(q, pandas_scaled))
    i = F.floor(p)
    return i, F.least(i + 1, F.col("n") - 1), p - i


def value_counts(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., x, c): distinct values without NULL and NaN, and how often they occur."""
    x = df.select(*[F.col(k) for k in by], F.col(col).cast("double").alias("x"))
    return x.where(F.col("x").isNotNull() & ~F.isnan("x")).groupBy(*by, "x").agg(F.count(F.lit(1)).alias("c"))


def quantiles_of_counts(vc: DataFrame, qs: Sequence[float], by: Sequence[str] = (),
                        pandas_scaled: bool = False, prefix: str = "q") -> DataFrame:
    """Per group of ``by`` (or one row): ``n`` and ``{prefix}{k}`` per q, from ``value_counts``."""
    by = list(by)
    ranged = vc.repartitionByRange(*by, "x").withColumn("part", F.spark_partition_id())
    ranged = materialize(ranged, "checkpoint")
    totals = ranged.groupBy(*by, "part").agg(F.sum("c").alias("t"))
    # one row per group and range partition: bounded by the number of partitions
    group = Window.partitionBy(*(by or [F.lit(0)]))
    before = F.sum("t").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.select(*by, "part", "t", F.coalesce(before, F.lit(0)).alias("offset"), F.sum("t").over(group).alias("n"))
    wanted = F.array(*[r for q in qs for r in _ranks(q, pandas_scaled)[:2]])
    inside = F.exists(wanted, lambda r: (r >= F.col("offset")) & (r < F.col("offset") + F.col("t")))
    held = totals.where(inside).select(*by, "part", "offset", "n")
    running = F.sum("c").over(Window.partitionBy(*by, "part").orderBy("x").rowsBetween(Window.unboundedPreceding, 0))
    cum = ranged.join(held, [*by, "part"]).select(
        *by, "x", "n", (F.col("offset") + running).alias("cum"), (F.col("offset") + running - F.col("c")).alias("low"))
    aggs = [F.max("n").alias("n")]
    for k, q in enumerate(qs):
        i, j, g = _ranks(q, pandas_scaled)
        aggs.append(F.max(F.when((F.col("low") <= i) & (i < F.col("cum")), F.col("x"))).alias(f"_lo{k}"))
        aggs.append(F.max(F.when((F.col("low") <= j) & (j < F.col("cum")), F.col("x"))).alias(f"_hi{k}"))
        aggs.append(F.max(g).alias(f"_g{k}"))
    agg = cum.groupBy(*by).agg(*aggs)
    return agg.select(*by, F.coalesce("n", F.lit(0)).cast("long").alias("n"), *[
        _lerp(F.col(f"_lo{k}"), F.col(f"_hi{k}"), F.col(f"_g{k}")).alias(f"{prefix}{k}") for k in range(len(qs))])


def exact_quantiles(df: DataFrame, col: str, qs: Sequence[float], by: Sequence[str] = (),
                    pandas_scaled: bool = False, prefix: str = "q") -> DataFrame:
    """Per group of ``by``: ``n`` and ``{prefix}{k}`` per q; without ``by`` one row, also for empty input."""
    return quantiles_of_counts(value_counts(df, col, by), qs, by, pandas_scaled, prefix)


def tertile_edges(df: DataFrame, col: str, method: str = "pandas") -> DataFrame:
    """One row (n, e1, e2, lowest, highest): the 1/3 and 2/3 edges of ``col`` and its ends, by ``selection``.

    ``pandas`` passes q through percent as pandas does; ``percentile`` uses q as it is.
    """
    s = select(df, [col], [1 / 3, 2 / 3], pandas_scaled=method == "pandas")[col]
    return df.sparkSession.createDataFrame([(s.n, *s.quantiles, s.lowest, s.highest)], "n long, e1 double, e2 double, lowest double, highest double")


def tertile_label(x: Column, edges: Column, labels: tuple[str, str, str]) -> Column:
    """Bin by the edges in ``edges`` (a struct e1, e2): <= e1, <= e2, else."""
    e1, e2 = edges.getField("e1"), edges.getField("e2")
    return (F.when(x.isNull(), F.lit(None).cast("string"))
             .when(x <= e1, F.lit(labels[0]))
             .when(x <= e2, F.lit(labels[1]))
             .otherwise(F.lit(labels[2])))
