"""Scalar column expressions (built-in functions only, so they stay in codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockcast.config import (
    INVOICE_DATE_FORMAT, INVOICE_DATE_TEXT_FORMAT, PRODUCT_PREFIX,
    TWO_DIGIT_YEAR_PIVOT, UNKNOWN_DESCRIPTION,
)


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: Column | str) -> Column:
    """NaN -> NULL. Spark orders NaN above every number; pandas treats it as missing."""
    return F.nanvl(_c(c), F.lit(None).cast("double"))


def money_sum(c: Column | str) -> Column:
    """Sum of an amount, 0 if there is none. Each row counts as decimal(18,4), so the
    total is exact and does not depend on the order in which tasks add it up."""
    return F.coalesce(F.sum(nan_to_null(c).cast("decimal(18,4)")).cast("double"), F.lit(0.0))


def half_even(c: Column | str, places: int = 0) -> Column:
    """Round like NumPy: rint(x * 10^p) / 10^p, ties to even, pure double arithmetic."""
    if places == 0:
        return F.rint(_c(c))
    scale = float(10 ** places)
    return F.rint(_c(c) * F.lit(scale)) / F.lit(scale)


def parse_invoice_date(c: Column | str, strict: bool = True) -> Column:
    """Text day/month/two-digit-year hour:minute -> timestamp without time zone.

    One-digit fields are accepted; two-digit years 69..99 map to 19xx, 00..68
    to 20xx. ``strict`` raises on text that does not parse (ANSI), otherwise
    such values become NULL.
    """
    if strict:
        ts = F.to_timestamp_ntz(_c(c), F.lit(INVOICE_DATE_FORMAT))
    else:
        ts = F.try_to_timestamp(_c(c), F.lit(INVOICE_DATE_FORMAT)).cast("timestamp_ntz")
    return F.when(F.year(ts) > TWO_DIGIT_YEAR_PIVOT, ts - F.expr("INTERVAL 100 YEARS")).otherwise(ts)


def format_invoice_date(c: Column | str) -> Column:
    return F.date_format(_c(c), INVOICE_DATE_TEXT_FORMAT)


def display_name(description: Column | str, code: Column | str, unknown_too: bool = True) -> Column:
    """NULL (and, in reports, "Unknown") descriptions show as "Product <code>"."""
    d = _c(description)
    missing = d.isNull() | (d == UNKNOWN_DESCRIPTION) if unknown_too else d.isNull()
    return F.when(missing, F.concat(F.lit(PRODUCT_PREFIX), _c(code).cast("string"))).otherwise(d)


def truncate_label(c: Column | str, width: int, pad: bool = False) -> Column:
    """Longer than ``width`` -> first ``width`` characters and '...'; else as is (or padded)."""
    s = _c(c).cast("string")
    short = F.rpad(s, width, " ") if pad else s
    return F.when(F.length(s) > width, F.concat(F.substring(s, 1, width), F.lit("..."))).otherwise(short)


def md5_bucket(cols: list[Column | str], seed: int, modulus: int = 100) -> Column:
    """Repeatable bucket 0..modulus-1 from md5 of the values and a seed (NULLs skipped)."""
    key = F.concat_ws("|", *[_c(c).cast("string") for c in cols], F.lit(str(seed)))
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint"), F.lit(modulus))
