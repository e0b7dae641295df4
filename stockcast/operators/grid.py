"""Forests and boosting grown on a grid of feature bins, for many training rows.

The tree learners of Spark ML walk every row once per tree and level. They see a
row only through its bins, though: 32 at most per feature, fewer for month, day
and weekday. Here the rows are added up by grid cell first (weight, weighted sum
and sum of squares of the target), and trees are grown on the cells. A node is a
box of the grid, so its histograms are sums over the box's other sides. What the
trees cost is bounded by the number of cells, however many rows there are.

Same as in Spark ML: the split candidates (from the same sampled rows), the gain,
ties, when a node is a leaf, and the boosting; a forest draws how often each
row counts in each tree from Poisson(1). Rows that are equal in cell, target and
weight draw together, n of them from Poisson(n), the distribution of the sum of
n such draws. Draws are seeded by block of cells, so they do not depend on the
partitioning. Spark ML draws by partition: a forest of more than ``GRID_ROWS``
rows is another sample of the same distribution than Spark ML's.

Each tree is grown by one task from the stats of its cells (``GRID_CELLS`` at
most), boosting by one task, as its rounds follow each other. The result is a
model of Spark ML, put together in its file format.
"""

from __future__ import annotations

import json
import math
import sys
import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockcast.config import FEATURE_COLUMNS, TARGET_COLUMN
from stockcast.session import ensure_checkpoint_dir

GRID_ROWS = 500_000      # up to so many training rows Spark ML's own learner is used
GRID_CELLS = 1 << 22     # a grid of more cells is not built (three doubles each in a task)
BLOCK_CELLS = 4096       # cells whose rows draw from one generator
ROWS_AT_ONCE = 512       # rows whose draws for all trees are held at once: they fit into a processor's cache
FEW = 8                  # Poisson counts of up to so many rows are looked up
EPSILON = 2.0 ** -52

NODE_SCHEMA = ("treeID int, nodeData struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:bigint,gain:double,"
               "leftChild:int,rightChild:int,split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>>")
NODE = pa.struct({"id": pa.int32(), "prediction": pa.float64(), "impurity": pa.float64(), "impurityStats": pa.list_(pa.float64()), "rawCount": pa.int64(),
                  "gain": pa.float64(), "leftChild": pa.int32(), "rightChild": pa.int32(),
                  "split": pa.struct({"featureIndex": pa.int32(), "leftCategoriesOrThreshold": pa.list_(pa.float64()), "numCategories": pa.int32()})})


register_pickle_by_value(sys.modules[__name__])  # executors need not have this package


# --- split candidates ---------------------------------------------------------------

def candidates(values: np.ndarray, weights: np.ndarray, expected: float, most: int) -> list[float]:
    """Spark ML's thresholds of one feature from sampled values.

    ``expected``: the weight that the sample stands for; what the values other
    than zero leave of it counts as zeros. ``most``: number of thresholds.
    """
    kept = values != 0.0
    if not kept.any():
        return []
    distinct, at = np.unique(values[kept], return_inverse=True)
    counts = np.bincount(at, weights=weights[kept])
    zeros = expected - counts.sum()
    if zeros > EPSILON * kept.sum() * 100:
        place = int(np.searchsorted(distinct, 0.0))
        distinct, counts = np.insert(distinct, place, 0.0), np.insert(counts, place, zeros)
    middles = ((distinct[:-1] + distinct[1:]) / 2.0).tolist()
    if len(middles) <= most:
        return middles
    stride = expected / (most + 1)
    found, target, seen = [], stride, float(counts[0])
    for middle, count in zip(middles, counts[1:].tolist(), strict=True):
        before, seen = seen, seen + count
        if abs(before - target) < abs(seen - target):
            found.append(middle)
            target += stride
    return found


def thresholds(train: DataFrame, rows: int, max_bins: int, seed: int, weight: str | None) -> list[list[float]]:
    """The split candidates of every feature, from the rows that Spark ML samples for them."""
    spark = train.sparkSession
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    columns = train.select(*[F.col(c).cast("double").alias(c) for c in FEATURE_COLUMNS], w.alias("_w"))
    bins = min(max_bins, rows)
    fraction = min(1.0, max(bins * bins, 10_000) / rows)
    draw = spark.sparkContext._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
    # the sample of an RDD, as the learners draw it; a DataFrame's has other rows
    sampled = columns._jdf.javaRDD().sample(False, fraction, draw)
    found = DataFrame(spark._jsparkSession.createDataFrame(sampled, columns._jdf.schema()), spark).collect()
    table = np.array([[np.nan if v is None else v for v in r] for r in found], dtype=np.float64).reshape(-1, len(FEATURE_COLUMNS) + 1)
    expected = fraction * (float(columns.agg(F.sum("_w")).first()[0]) if weight else rows)
    return [candidates(table[:, i], table[:, -1], expected, bins - 1) for i in range(len(FEATURE_COLUMNS))]


# --- draws --------------------------------------------------------------------------

@lru_cache(FEW)
def _poisson_table(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cumulated Poisson(n), count at the lower end of each 4096th of [0, 1), whether all of it has this count)."""
    cumulated = np.cumsum([math.exp(-n) * n ** k / math.factorial(k) for k in range(64)])
    ends = np.arange(4097) / 4096
    low = np.searchsorted(cumulated, ends[:-1], side="right")
    return cumulated, low.astype(np.float64), low == np.searchsorted(cumulated, ends[1:], side="left")


class Draws:
    """How often the rows of a block count in each tree, the same whether asked for in one or many calls."""

    def __init__(self, seed: int, block: int):
        self.few, self.many = (np.random.Generator(np.random.PCG64([seed & 0xFFFFFFFFFFFFFFFF, block, i])) for i in range(2))

    def times(self, n: np.ndarray, trees: int) -> np.ndarray:
        """One line per entry of ``n``, the number of equal rows; one Poisson(n) per tree."""
        out = np.empty((len(n), trees))
        many = n > FEW
        if many.any():
            out[many] = self.many.poisson(n[many, None], (int(many.sum()), trees))
        u = self.few.random((int((~many).sum()), trees))
        for value in np.unique(n[~many]).tolist():
            cumulated, low, whole = _poisson_table(value)
            x = u[n[~many] == value].ravel()
            place = (x * 4096).astype(np.int32)
            found = low[place]
            between = np.flatnonzero(~whole[place])
            found[between] = np.searchsorted(cumulated, x[between], side="right")
            out[n == value] = found.reshape(-1, trees)
        return out


# --- rows to cells ------------------------------------------------------------------

def _numbers(batch: pa.RecordBatch, name: str, infinite: bool = False) -> np.ndarray:
    column = batch.column(name)
    if column.null_count:
        raise ValueError(f"null in {name}: a missing value is an error, never a dropped row")
    values = column.to_numpy(zero_copy_only=False)
    if np.isnan(values).any() or not infinite and np.isinf(values).any():
        raise ValueError(f"NaN, null or infinite value in {name}")
    return values


def cell_rows(train: DataFrame, splits: list[list[float]], weight: str | None) -> DataFrame:
    """cell, y, w, n: how many rows of a cell have that target and weight."""
    edges = [np.array(s) for s in splits]
    sizes = [len(s) + 1 for s in splits]

    def binned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell = np.zeros(b.num_rows, dtype=np.int64)
            for name, edge, size in zip(FEATURE_COLUMNS, edges, sizes, strict=True):
                cell = cell * size + np.searchsorted(edge, _numbers(b, name, infinite=True))
            w = _numbers(b, "w")
            if (w < 0).any():
                raise ValueError("negative weight")
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(_numbers(b, "y")), pa.array(w)], names=["cell", "y", "w"])

    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    columns = train.select(*[F.col(c).cast("double").alias(c) for c in FEATURE_COLUMNS], F.col(TARGET_COLUMN).cast("double").alias("y"), w.alias("w"))
    return columns.mapInArrow(binned, "cell long, y double, w double").groupBy("cell", "y", "w").agg(F.count(F.lit(1)).alias("n"))


def tree_cells(rows: DataFrame, trees: int, seed: int | None, weighted: bool) -> DataFrame:
    """tree, block, cells in it, their stats, a partition per tree; ``seed`` None: every row counts once.

    Stats are weight, weighted sum and sum of squares, and the number of rows where weights are not all 1.
    """
    spark = rows.sparkSession
    parts = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.withColumn("block", F.floor(F.col("cell") / BLOCK_CELLS)).repartition(parts, "block").sortWithinPartitions("cell", "y", "w")

    def written(block: int, pieces: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        cells = np.concatenate([c for c, _ in pieces])
        stats = np.concatenate([s for _, s in pieces], axis=1)
        first = np.flatnonzero(np.diff(cells, prepend=-1))  # a cell's rows may lie in two pieces
        stats = np.ascontiguousarray(np.add.reduceat(stats, first, axis=1).transpose(2, 0, 1))
        at = (cells[first] - block * BLOCK_CELLS).astype(np.int16).tobytes()
        return pa.RecordBatch.from_arrays([pa.array(range(trees), pa.int32()), pa.array([block] * trees, pa.int64()), pa.array([at] * trees, pa.binary()),
                                           pa.array([s.tobytes() for s in stats], pa.binary())], names=["tree", "block", "cells", "stats"])

    def drawn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, pieces, random = -1, [], None
        for b in batches:
            cell, y, w, n, of = (b.column(c).to_numpy() for c in ("cell", "y", "w", "n", "block"))
            cuts = np.unique(np.concatenate([np.flatnonzero(np.diff(of, prepend=-1)), np.arange(0, len(of), ROWS_AT_ONCE), [len(of)]]))
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if of[lo] != block:
                    if pieces:
                        yield written(block, pieces)
                    block, pieces = int(of[lo]), []
                    random = None if seed is None else Draws(seed, block)
                times = n[lo:hi, None].astype(np.float64) if random is None else random.times(n[lo:hi], trees)
                counted = times * w[lo:hi, None]
                first = np.flatnonzero(np.diff(cell[lo:hi], prepend=-1))
                some = [counted, counted * y[lo:hi, None], counted * (y * y)[lo:hi, None], *([times] if weighted else [])]
                pieces.append((cell[lo:hi][first], np.stack([np.add.reduceat(x, first, axis=0) for x in some])))
        if pieces:
            yield written(block, pieces)

    return rows.mapInArrow(drawn, "tree int, block long, cells binary, stats binary").repartitionById(trees, "tree")


def filled(batches: Iterable[pa.RecordBatch], sizes: list[int], stats: int) -> tuple[int, np.ndarray] | None:
    """(tree, its grid: stats x bins of the first feature x ... x bins of the last); None without cells."""
    tree, grid = None, None
    for b in batches:
        for tree, block, cells, values in zip(*(b.column(c).to_pylist() for c in ("tree", "block", "cells", "stats")), strict=True):  # noqa: B007
            if grid is None:
                grid = np.zeros((stats, int(np.prod(sizes))))
            grid[:, block * BLOCK_CELLS + np.frombuffer(cells, dtype=np.int16).astype(np.int64)] = np.frombuffer(values).reshape(stats, -1)
    return None if grid is None else (tree, grid.reshape(stats, *sizes))


# --- trees --------------------------------------------------------------------------

def histograms(box: np.ndarray) -> list[np.ndarray]:
    """For every side of the box the stats by its bins."""
    out = []
    for axis in range(box.ndim - 1, 0, -1):
        out.append(box.sum(axis=tuple(range(1, axis))) if axis > 1 else box)
        if axis > 1:
            box = box.sum(axis=axis)
    return out[::-1]


def _variance(s):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(s[0] == 0, 0.0, (s[2] - s[1] * s[1] / s[0]) / s[0])


def best_split(box: np.ndarray) -> tuple | None:
    """(gain, feature, bin, left stats, right stats) of the best valid split, the first on ties; None without one."""
    best = None
    for feature, bins in enumerate(histograms(box)):
        if bins.shape[1] < 2:
            continue
        sums = np.cumsum(bins, axis=1)
        left, all_ = sums[:, :-1], sums[:, -1:]
        right = all_ - left
        gain = _variance(all_) - left[0] / all_[0] * _variance(left) - right[0] / all_[0] * _variance(right)
        gain[(left[-1 if len(bins) > 3 else 0] < 1) | (right[-1 if len(bins) > 3 else 0] < 1) | ~(gain >= 0)] = -np.inf
        at = int(np.argmax(gain))
        if gain[at] > (best[0] if best else 0.0):
            best = (float(gain[at]), feature, at, left[:, at], right[:, at])
    return best


def grow(grid: np.ndarray, splits: list[list[float]], depth: int) -> tuple[list[tuple], list[tuple[tuple, float]]]:
    """One regression tree: its nodes in Spark ML's order and form, and its leaves as (box, prediction)."""
    leaves = []

    def node(box: tuple, s: np.ndarray, level: int):
        found = best_split(grid[(slice(None), *box)]) if level < depth and (level == 0 or abs(float(_variance(s))) >= EPSILON) else None
        if found is None:
            leaves.append((box, float(s[1] / s[0])))
            return s, None
        gain, feature, at, left, right = found
        # the box's sides are cut by bin numbers of the whole grid
        start, stop = box[feature].start, box[feature].stop
        cut = start + at + 1
        sides = [(*box[:feature], part, *box[feature + 1:]) for part in (slice(start, cut), slice(cut, stop))]
        children = node(sides[0], left, level + 1), node(sides[1], right, level + 1)
        if all(c[1] is None for c in children) and children[0][0][1] / children[0][0][0] == children[1][0][1] / children[1][0][0]:
            return s, None  # Spark ML joins leaves that say the same
        return s, (gain, feature, splits[feature][cut - 1], *children)

    rows = []

    def numbered(of) -> int:
        s, split = of
        place = len(rows)
        said = (float(s[1] / s[0]), float(_variance(s)), [float(x) for x in s[:3]], round(float(s[-1 if len(s) > 3 else 0])))
        rows.append((place, *said, -1.0, -1, -1, (-1, [], -1)))
        if split:
            gain, feature, threshold, left, right = split
            a, b = numbered(left), numbered(right)
            rows[place] = (place, *said, gain, a, b, (feature, [float(threshold)], -1))
        return place

    whole = tuple(slice(0, n) for n in grid.shape[1:])
    numbered(node(whole, grid.reshape(len(grid), -1).sum(axis=1), 0))
    return rows, leaves


def boost(grid: np.ndarray, splits: list[list[float]], rounds: int, depth: int, step: float) -> Iterator[tuple[int, tuple]]:
    """(round, node) of gradient boosting with squared loss: each tree is grown on twice the residuals."""
    w, s, q = grid[0], grid[1], grid[2]
    score, now = np.zeros_like(w), grid.copy()
    for r in range(rounds):
        nodes, leaves = grow(now, splits, depth)
        yield from ((r, n) for n in nodes)
        for box, value in leaves:
            score[box] += value * (step if r else 1.0)
        now[1] = 2.0 * (s - w * score)
        now[2] = 4.0 * (q - 2.0 * score * s + w * score * score)


def _record(node: tuple) -> dict:
    names = [f.name for f in NODE]
    return dict(zip(names, (*node[:-1], dict(zip([f.name for f in NODE.field("split").type], node[-1], strict=True))), strict=True))


# --- models -------------------------------------------------------------------------

def _model(estimator, boosting: bool, nodes: DataFrame, count: int, weights: list[float], train: DataFrame, weight: str | None):
    """A Spark ML model of these trees: a model of one tree is saved, its trees replaced, and the whole loaded."""
    from stockcast.operators.model import assembler
    spark = train.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/grid-{uuid.uuid4()}"
    names = [*FEATURE_COLUMNS, TARGET_COLUMN, *([weight] if weight else [])]
    one = assembler().transform(spark.createDataFrame([tuple(float(i) for _ in names) for i in (1, 2)], [*names]))
    number = estimator.maxIter if boosting else estimator.numTrees
    estimator.copy({number: 1, estimator.maxDepth: 1}).fit(one).write().overwrite().save(f"{path}/one")
    said = json.loads(spark.read.text(f"{path}/one/metadata").first()[0])
    said["numTrees"], said["paramMap"][number.name], said["paramMap"]["maxDepth"] = count, count, estimator.getMaxDepth()
    tree = json.loads(spark.read.parquet(f"{path}/one/treesMetadata").first()[1])
    tree["paramMap"]["maxDepth"] = estimator.getMaxDepth()
    spark.createDataFrame([(json.dumps(said),)], "value string").coalesce(1).write.text(f"{path}/all/metadata")
    trees = [(i, json.dumps(tree | {"uid": f"{tree['uid']}_{i}"}), w) for i, w in enumerate(weights)]
    spark.createDataFrame(trees, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/all/treesMetadata")
    nodes.write.parquet(f"{path}/all/data")
    return (GBTRegressionModel if boosting else RandomForestRegressionModel).load(f"{path}/all")


def fit_on_grid(estimator, train: DataFrame, weight: str | None = None):
    """The fitted model; None where Spark ML's learner is to be used (few rows, or a grid with too many cells)."""
    rows = train.count()
    if rows <= GRID_ROWS:
        return None
    splits = thresholds(train, rows, estimator.getMaxBins(), estimator.getSeed(), weight)
    sizes = [len(s) + 1 for s in splits]
    if int(np.prod(sizes, dtype=object)) > GRID_CELLS:
        return None
    boosting, depth, stats = isinstance(estimator, GBTRegressor), estimator.getMaxDepth(), 4 if weight else 3
    count = estimator.getMaxIter() if boosting else estimator.getNumTrees()
    step = estimator.getStepSize() if boosting else None
    cells = tree_cells(cell_rows(train, splits, weight), 1 if boosting else count, None if boosting else estimator.getSeed(), weight is not None)

    def grown(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if found := filled(batches, sizes, stats):
            tree, grid = found
            nodes = boost(grid, splits, count, depth, step) if boosting else ((tree, n) for n in grow(grid, splits, depth)[0])
            while some := list(islice(nodes, 10_000)):
                yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in some], pa.int32()), pa.array([_record(n) for _, n in some], NODE)], names=["treeID", "nodeData"])

    weights = [1.0] + [step] * (count - 1) if boosting else [1.0] * count
    return _model(estimator, boosting, cells.mapInArrow(grown, NODE_SCHEMA), count, weights, train, weight)
