"""Column expressions shared by the operators (all JVM-side built-ins)."""

from stockcast.functions.columns import (
    display_name, half_even, md5_bucket, nan_to_null, parse_invoice_date,
    format_invoice_date, truncate_label,
)
from stockcast.functions.quantiles import exact_quantiles, tertile_edges

__all__ = [
    "display_name", "half_even", "md5_bucket", "nan_to_null", "parse_invoice_date",
    "format_invoice_date", "truncate_label", "exact_quantiles", "tertile_edges",
]
