"""Sums and means of doubles that do not depend on the order in which tasks add.

A double is split without error into its whole part and three pieces of 24 bits
(down to 2**-72; what is smaller is cut off, row by row). Pieces are integers,
and sums of integers are the same in any order; the four sums are put together
once per group:

    df.groupBy("k").agg(*pieces("x", F.col("x"))).select("k", total("x"), mean("x"))

``long`` sums take 2**39 rows and totals up to 2**63; ``wide`` keeps the whole
parts as decimals of 38 digits. Larger values raise.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

_BITS = 24
_UNIT = float(1 << _BITS)
_MASK = (1 << _BITS) - 1


def pieces(name: str, x: Column, wide: bool = False, over: WindowSpec | None = None) -> list[Column]:
    """Aggregates (or window functions) named after ``name``: the sums of the pieces of ``x`` and their number."""
    whole = x.cast("long")
    if wide:  # beyond 2**53 a double is whole
        whole = F.when(F.abs(x) < float(1 << 53), whole.cast("decimal(38,0)")).otherwise(x.cast("decimal(38,0)"))
    # scaling by powers of two and remainders by 1 are exact
    parts = [whole] + [((x * _UNIT ** k % 1.0) * _UNIT).cast("long") for k in range(3)]
    sums = [*(F.sum(p) for p in parts), F.count(x)]
    return [(s if over is None else s.over(over)).alias(f"_{name}_{i}") for i, s in enumerate(sums)]


def _value(sums: list[Column]) -> tuple[Column, Column]:
    """(whole part, value) of four sums after carrying."""
    carry, scale, fraction = F.lit(0).cast("long"), 2.0 ** -(3 * _BITS), F.lit(0.0)
    for s in reversed(sums[1:]):
        s = s + carry
        carry = F.shiftright(s, _BITS)
        fraction = s.bitwiseAND(F.lit(_MASK)).cast("double") * scale + fraction
        scale *= _UNIT
    whole = sums[0] + carry
    return whole, whole.cast("double") + fraction


def total(name: str) -> Column:
    """The sum from ``pieces``, equal to the bit for every partitioning; NULL without values."""
    sums = [F.col(f"_{name}_{i}") for i in range(4)]
    whole, value = _value(sums)
    # from below zero the fraction would be counted up from the next smaller whole number and lose digits
    return F.when(whole < 0, -_value([-s for s in sums])[1]).otherwise(value)


def mean(name: str) -> Column:
    """The mean from ``pieces``."""
    return F.try_divide(total(name), F.col(f"_{name}_4"))


def number(sums: list) -> float:
    """The sum from the four collected sums of pieces, on the driver."""
    return float(sum(Fraction(int(s), 1 << (_BITS * i)) for i, s in enumerate(sums)))


def piece_names(name: str) -> list[str]:
    """The columns that ``pieces`` gives."""
    return [f"_{name}_{i}" for i in range(5)]
