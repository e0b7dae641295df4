"""Run settings and the fixed values the results depend on."""

from __future__ import annotations

from dataclasses import dataclass, replace

# ---------------------------------------------------------------------------
# These must stay as they are for results to match the
# original tool's output (names, labels, ranges, bins, table sizes).
# ---------------------------------------------------------------------------
EXPECTED_COLUMNS = (
    "Invoice", "StockCode", "Description", "Quantity",
    "InvoiceDate", "Price", "Customer ID", "Country",
)
INVOICE_PATTERN = r"^[0-9C]+$"
CANCEL_PREFIX = "C"
# %d/%m/%y %H:%M, written so that one-digit fields also parse
INVOICE_DATE_FORMAT = "d/M/yy H:m"
INVOICE_DATE_TEXT_FORMAT = "dd/MM/yy HH:mm"
TWO_DIGIT_YEAR_PIVOT = 2068  # 69..99 -> 1969..1999, 00..68 -> 2000..2068

FEATURE_COLUMNS = ("Lag1_Quantity", "Rolling7_Quantity", "Month", "Day", "DayOfWeek")
TARGET_COLUMN = "Quantity"
DEMAND_COLUMN = "predicted_weekly_demand"
DEMAND_COLUMN_ALT = "predicted_demand"

PRIORITY_LABELS = ("Low", "Medium", "High")
UNKNOWN_DESCRIPTION = "Unknown"
PRODUCT_PREFIX = "Product "

# restock_ranges: (low, high, label), both ends inclusive
RESTOCK_RANGES = (
    (0, 10, "Low (0-10)"),
    (11, 50, "Medium (11-50)"),
    (51, 200, "High (51-200)"),
    (201, float("inf"), "Very High (>200)"),
)
# restock_histogram: left-closed bins, the last one closed at max + 1
HISTOGRAM_EDGES = (0, 10, 50, 100, 200, 500, 1000)
HISTOGRAM_LABELS = ("0-10", "11-50", "51-100", "101-200", "201-500", "501-1000", ">1000")

# stratified picks per priority: (High, Medium, Low)
PICKS_CONSOLE = (5, 5, 5)
PICKS_REPORT_TABLES = (5, 4, 3)
PICKS_CHART = (4, 3, 3)
PICKS_TREND = (2, 2, 1)
PICKS_SHORT_MARKDOWN = (5, 3, 2)
PICKS_SHORT_HTML = (5, 4, 3)

TOP_CHART = 10          # plain top list when nothing has a priority
TOP_DASHBOARD = 50      # rows of the dashboard table
TOP_SUMMARY = 3         # names in the summary text
TOP_PROMPT = 5          # items in the overall summary prompt
LAST_ROWS_TREND = 5     # rows in the "recent" mean of a product trend

LABEL_WIDTH_CONSOLE = 37
LABEL_WIDTH_DASHBOARD = 30
LABEL_WIDTH_CHART = 25

SAMPLE_ROWS = 500
SEED = 42
TRAIN_SHARE_PERCENT = 80

TREND_TEXT = "Analysis for %s: Sales averaging %s units daily, with a %s trend."
REASONING_TEXT = "Recommendation based on historical demand patterns and safety stock calculations."
SUMMARY_TEXT = (
    "The system has identified %d products that need restocking, with %d items "
    "requiring urgent attention (above average restock amounts)."
)


@dataclass(frozen=True)
class RestockConfig:
    """One code path, two variants (the training script and the predict script).

    ``min_rows``      feature rows a product needs (10 training, 5 predict)
    ``drop_any_null`` predict drops feature rows with any NULL, training only
                      rows without a lag
    ``descriptions``  'fanout': join every (code, description) pair onto the daily
                      rows (training); 'lookup': first description on the result
    ``null_std``      'fallback': NULL spread -> fallback_share * demand (predict);
                      'keep': stays NULL, so restock and priority are NULL
    ``cost``          'unrounded_2dp': unrounded restock * price, 2 places (predict);
                      'rounded': rounded restock * price, not rounded (training)
    ``edges``         'pandas': tertile edges by pandas' interpolation (qcut);
                      'percentile': the same with q as it is (Spark's percentile)
    """

    variant: str = "predict"
    min_rows: int = 5
    drop_any_null: bool = True
    descriptions: str = "lookup"
    null_std: str = "fallback"
    fallback_share: float = 0.2
    cost: str = "unrounded_2dp"
    last_n_days: int = 30
    horizon: int = 7
    safety_factor: float = 1.5
    lead_time: int = 7
    coerce_customer: bool = False
    edges: str = "pandas"
    strict_edges: bool = False

    def with_(self, **kw) -> "RestockConfig":
        return replace(self, **kw)


PREDICT = RestockConfig()
TRAINING = RestockConfig(
    variant="training",
    min_rows=10,
    drop_any_null=False,
    descriptions="fanout",
    null_std="keep",
    cost="rounded",
    coerce_customer=True,
)

# ---------------------------------------------------------------------------
# Prompt texts of the insight step, in this project's own wording (the figures
# they carry are the original's). The table of prompts is built for a later
# batch job; no model is called here.
# ---------------------------------------------------------------------------
PROMPT_OVERALL = """You advise inventory managers. Current restocking figures:

Products to restock: %s
Above the average amount (urgent): %s

Largest recommendations:
%s

Summarise the situation in a few short paragraphs: what stands out, what to
order first, what it may cost, and any figure that looks wrong."""

PROMPT_TREND = """Sales figures of product "%s":
- mean units a day: %s
- most units in a day: %s
- direction lately: %s

Explain in one paragraph what this means for stocking the product."""

PROMPT_REASONING = """In two or three sentences, say why this order makes sense.
Product: %s
Expected demand of the week: %s
Safety stock: %s
Recommended order: %s"""

PROMPT_FORECAST = """Forecast of one product:
- name: %s
- mean units a day now: %s
- recommended order: %s
- days covered: %s

Put the recommendation into plain words, with what drives the demand and what to do."""
