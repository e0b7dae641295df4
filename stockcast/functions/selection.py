"""Exact order statistics of whole columns by bracketing ranks with a mergeable sketch.

1. One scan builds a KLL sketch per column (Spark's own), first per ``slices``
   of the tasks, then merged, and gives number, smallest and largest value. The
   sketch says between which two values each wanted rank lies, give or take its
   error: a bracket.
2. While a bracket holds more than its share of ``LIMIT`` rows, a scan counts the
   rows below it, inside it and at its ends and sketches the inside: the rank is
   at one of the ends, or the bracket gets narrower, some hundred times per scan.
3. A last scan counts the rows between the brackets and, value by value, inside
   them. That proves where each rank lies; a rank that a sketch has missed gets
   the gap that holds it as its bracket, and step 2 goes on.

What is shuffled and what reaches the driver is bounded by the sketch's size and
``LIMIT``, whatever the number of rows and of distinct values. A value that many
rows share counts once. The interpolation between x[i] and x[i+1] is NumPy's
two-sided linear form; ``pandas_scaled`` passes q through percent as pandas does.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockcast.functions.columns import nan_to_null
from stockcast.functions.exact import number, piece_names, pieces

SKETCH_K = 4096   # rank error of about 0.13 %
MARGIN = 0.005    # of the rows inside: how far a bracket reaches to both sides of its rank
LIMIT = 100_000   # rows in brackets that are counted value by value


@dataclass
class Selected:
    """Of one column: number of values, their smallest, largest, mean and sample std, and the wanted quantiles."""

    n: int = 0
    lowest: float | None = None
    highest: float | None = None
    mean: float | None = None
    std: float | None = None
    quantiles: list[float | None] = field(default_factory=list)


@dataclass
class _Bracket:
    """lo <= x[rank] <= hi, as far as the sketch can tell, with about ``inside`` rows (None: any number)."""

    rank: int
    lo: float
    hi: float
    inside: int | None = None


def _value(name: str) -> Column:
    return nan_to_null(F.col(f"`{name}`").cast("double"))


def _tree(df: DataFrame, parts: dict[str, tuple[Column, str]]) -> dict:
    """One row of aggregates, reduced in two steps; the second element names how two results are merged."""
    merge = {"sum": F.sum, "min": F.min, "max": F.max, "sketch": F.kll_merge_agg_double}
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = df.groupBy(F.pmod(F.spark_partition_id(), F.lit(slices)).alias("_slice")).agg(*[c.alias(n) for n, (c, _) in parts.items()])
    row = first.agg(*[merge[how](n).alias(n) for n, (_, how) in parts.items()]).first()
    return row.asDict()


def _cuts(df: DataFrame, sketch: bytes | None, shares: list[float]) -> list[float]:
    if sketch is None or not shares:
        return []
    one = df.sparkSession.createDataFrame([(bytearray(sketch),)], "s binary")
    return list(one.select(F.kll_sketch_get_quantile_double("s", F.array(*map(F.lit, shares)))).first()[0])


def _around(share: float) -> list[float]:
    return [max(0.0, share - MARGIN), min(1.0, share + MARGIN)]


def _refine(df: DataFrame, brackets: dict[str, list[_Bracket]]) -> None:
    """Count below, inside and at the ends of brackets, and narrow them: each loses its end values or is one of them."""
    flat = [(f"{i}_{k}", c, b) for i, (c, bs) in enumerate(brackets.items()) for k, b in enumerate(bs)]
    parts: dict[str, tuple[Column, str]] = {}
    for key, c, b in flat:
        x = _value(c)
        inside = (x >= b.lo) & (x <= b.hi)
        for name, rows in {"below": x < b.lo, "inside": inside, "lo": x == b.lo, "hi": x == b.hi}.items():
            parts[f"{name}_{key}"] = (F.count(F.when(rows, 1)), "sum")
        parts[f"sketch_{key}"] = (F.kll_sketch_agg_double(F.when(inside, x), F.lit(SKETCH_K)), "sketch")
    got = _tree(df, parts)
    for key, _, b in flat:
        below, inside, at_lo, at_hi = (got[f"{n}_{key}"] for n in ("below", "inside", "lo", "hi"))
        if not below <= b.rank < below + inside:  # missed: anywhere on that side
            b.lo, b.hi = (-math.inf, math.nextafter(b.lo, -math.inf)) if b.rank < below else (math.nextafter(b.hi, math.inf), math.inf)
            b.inside = None
        elif b.rank < below + at_lo:
            b.hi = b.lo
        elif b.rank >= below + inside - at_hi:
            b.lo = b.hi
        else:
            lo, hi = _cuts(df, got[f"sketch_{key}"], _around((b.rank - below) / inside))
            b.lo, b.hi = max(math.nextafter(b.lo, math.inf), lo), min(math.nextafter(b.hi, -math.inf), hi)
            b.inside = math.ceil(2 * MARGIN * inside) + 1


def _count(df: DataFrame, brackets: dict[str, list[_Bracket]], means: dict[str, float] | None) -> tuple[dict[str, list[tuple]], dict[str, float]]:
    """Per column: (gap or bracket, value, rows) in ascending order, and with ``means`` the sum of squared deviations.

    Regions 0, 2, 4, ... lie between the merged brackets, 1, 3, 5, ... are the brackets; only rows of these keep their value.
    """
    merged: dict[str, list[list[float]]] = {}
    for c, bs in brackets.items():
        spans: list[list[float]] = []
        for lo, hi in sorted((b.lo, b.hi) for b in bs):
            if spans and lo <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], hi)
            else:
                spans.append([lo, hi])
        merged[c] = spans
    rows = []
    for c, spans in merged.items():
        x, region = _value(c), F.lit(0)
        for lo, hi in spans:
            region = region + (x >= lo).cast("int") + (x > hi).cast("int")
        mean = F.lit(means[c] if means else None).cast("double")
        rows.append(F.struct(F.lit(c).alias("column"), region.alias("region"), x.alias("x"), mean.alias("mean")))
    long = df.select(F.explode(F.array(*rows)).alias("r")).select("r.*").where("x is not null")
    off = F.col("x") - F.col("mean")
    kept = F.when(F.col("region") % 2 == 1, F.col("x"))
    names = piece_names("ss")[:4] if means else []
    sums = pieces("ss", off * off, wide=True) if means else []
    counted = long.groupBy("column", "region", kept.alias("x")).agg(F.count(F.lit(1)).alias("c"), *sums)
    out: dict[str, list[tuple]] = {c: [] for c in merged}
    squares = {c: [0, 0, 0, 0] for c in merged}
    for r in counted.collect():  # at most LIMIT values and a row per gap
        out[r["column"]].append((r["region"], r["x"] if r["x"] is not None else 0.0, r["c"]))
        squares[r["column"]] = [a + int(r[n]) for a, n in zip(squares[r["column"]], names)]
    return {c: sorted(v) for c, v in out.items()}, {c: number(s) for c, s in squares.items()} if means else {}


def select(df: DataFrame, columns: Sequence[str], qs: Sequence[float], pandas_scaled: bool = False) -> dict[str, Selected]:
    """Statistics and the exact quantiles ``qs`` of every column, without NULL and NaN."""
    parts: dict[str, tuple[Column, str]] = {}
    for i, c in enumerate(columns):
        x = _value(c)
        parts |= {f"n_{i}": (F.count(x), "sum"), f"lo_{i}": (F.min(x), "min"), f"hi_{i}": (F.max(x), "max"),
                  f"s_{i}": (F.kll_sketch_agg_double(x, F.lit(SKETCH_K)), "sketch")}
        parts |= {name: (piece, "sum") for name, piece in zip(piece_names(f"x{i}"), pieces(f"x{i}", x, wide=True), strict=True)}
    got = _tree(df, parts)
    means = {c: number([got[n] for n in piece_names(f"x{i}")[:4]]) / got[f"n_{i}"] if got[f"n_{i}"] else None for i, c in enumerate(columns)}
    scaled = [(q * 100) / 100 if pandas_scaled else q for q in qs]
    found = {c: Selected(got[f"n_{i}"] or 0, got[f"lo_{i}"], got[f"hi_{i}"], means[c]) for i, c in enumerate(columns)}
    brackets: dict[str, list[_Bracket]] = {}
    for i, c in enumerate(columns):
        f = found[c]
        if not f.n:
            continue
        ranks = sorted({r for q in scaled for r in _ranks(f.n, q)[:2]})
        cuts = _cuts(df, got[f"s_{i}"], [p for r in ranks for p in _around(r / f.n)])
        brackets[c] = []
        for r, lo, hi in zip(ranks, cuts[::2], cuts[1::2], strict=True):
            # the ends are known; a bracket that reaches beyond the margin's share of the rows ends there
            lo, hi = (f.lowest if r / f.n <= MARGIN else lo), (f.highest if r / f.n >= 1 - MARGIN else hi)
            lo, hi = (f.lowest, f.lowest) if r == 0 else (f.highest, f.highest) if r == f.n - 1 else (lo, hi)
            brackets[c].append(_Bracket(r, lo, hi, math.ceil(2 * MARGIN * f.n)))

    values, squares = _find(df, brackets, means)
    for c, f in found.items():
        f.std = math.sqrt(squares[c] / (f.n - 1)) if f.n > 1 else None
        f.quantiles = [_between(values[c], f.n, q) if f.n else None for q in scaled]
    return found


def order_statistic(df: DataFrame, column: str, rank: int) -> tuple[int, float, int]:
    """(number of values, the value of ``rank`` from 0, number of values below it) of one column."""
    x = _value(column)
    got = _tree(df, {"n": (F.count(x), "sum"), "s": (F.kll_sketch_agg_double(x, F.lit(SKETCH_K)), "sketch")})
    if not 0 <= rank < (got["n"] or 0):
        raise ValueError(f"no rank {rank} among {got['n']} values")
    lo, hi = _cuts(df, got["s"], _around(rank / got["n"]))
    below: dict[str, dict[int, int]] = {}
    values, _ = _find(df, {column: [_Bracket(rank, lo, hi, math.ceil(2 * MARGIN * got["n"]))]}, None, below)
    return got["n"], values[column][rank], below[column][rank]


def _find(df: DataFrame, brackets: dict[str, list[_Bracket]], means: dict[str, float] | None,
          below: dict[str, dict[int, int]] | None = None) -> tuple[dict[str, dict[int, float]], dict[str, float]]:
    """Per column: the value of every bracket's rank, and with ``means`` the sum of squared deviations from the mean."""
    values: dict[str, dict[int, float]] = {c: {} for c in brackets}
    squares: dict[str, float] = {}
    while any(brackets.values()):
        share = LIMIT // sum(map(len, brackets.values()))
        if wide := {c: w for c, bs in brackets.items() if (w := [b for b in bs if b.lo < b.hi and (b.inside is None or b.inside > max(1, share))])}:
            _refine(df, wide)
            continue
        counted, ss = _count(df, brackets, means)
        squares |= ss
        for c, bs in brackets.items():
            missed = []
            for b in bs:
                before, last = 0, -math.inf
                for region, x, rows in counted[c]:
                    if b.rank < before + rows:
                        if region % 2:
                            values[c][b.rank] = x
                            if below is not None:
                                below.setdefault(c, {})[b.rank] = before
                        else:  # in a gap: from the bracket before it to the one after it
                            after = [y for reg, y, _ in counted[c] if reg > region]
                            missed.append(_Bracket(b.rank, last, min(after, default=math.inf)))
                        break
                    before, last = before + rows, x if region % 2 else last
            brackets[c] = missed
    return values, squares


def _ranks(n: int, q: float) -> tuple[int, int, float]:
    p = float(n - 1) * q
    i = math.floor(p)
    return i, min(i + 1, n - 1), p - i


def _between(x: dict[int, float], n: int, q: float) -> float:
    i, j, g = _ranks(n, q)
    lo, hi = x[i], x[j]
    return hi - (hi - lo) * (1 - g) if g >= 0.5 else lo + (hi - lo) * g
