"""The restock flow against arrays: one row per product, one column per calendar day.

Every figure is a formula over that matrix (no product loop, no SQL, no shared
code): a product's first sale day drops out, ``latest`` is the last column
with a sale, the window is the 31 columns up to it, and over any 7 days in a
row the weekday terms of the fixed scorer cancel, so weekly demand is
7 * (0.75 * window mean + 0.25 * last sale).
"""

import duckdb
import numpy as np
import pandas as pd
import pytest

from stockcast.config import PREDICT, TRAINING
from stockcast.operators.restock import baseline_scorer, restock_recommendations
from stockcast.sources.star import SALES_SQL
from tests.conftest import SF_SMALL


def _sales() -> pd.DataFrame:
    c = duckdb.connect()
    for t in ("lineitem", "orders", "customer", "nation", "part"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c.sql("WITH " + SALES_SQL.strip() + " SELECT * FROM sales").df()


def _expected(sales: pd.DataFrame, least_rows: int, fallback: bool) -> pd.DataFrame:
    kept = sales[(sales.Quantity > 0) & ~sales.Invoice.astype(str).str.startswith("C")]
    codes, row = np.unique(kept.StockCode.to_numpy(str), return_inverse=True)
    day = kept.InvoiceDate.to_numpy("datetime64[D]").astype(int)
    col = day - day.min()
    shape = (len(codes), col.max() + 1)
    units, price, lines = np.zeros(shape), np.zeros(shape), np.zeros(shape)
    np.add.at(units, (row, col), kept.Quantity)
    np.add.at(price, (row, col), kept.Price)
    np.add.at(lines, (row, col), 1)
    sold = lines > 0
    sold[np.arange(len(codes)), sold.argmax(axis=1)] = False  # no lag on the first day
    latest = np.flatnonzero(sold.any(axis=0)).max()
    window = sold & (np.arange(shape[1]) >= latest - 30)
    n = window.sum(axis=1)
    with np.errstate(all="ignore"):
        mean = (units * window).sum(axis=1) / n
        spread = np.sqrt((((units - mean[:, None]) ** 2) * window).sum(axis=1) / (n - 1))
        paid = (np.where(lines > 0, price / lines, 0) * window).sum(axis=1) / n
        last = units[np.arange(len(codes)), shape[1] - 1 - sold[:, ::-1].argmax(axis=1)]
        demand = 7 * (0.75 * mean + 0.25 * last)
        safety = 1.5 * spread * np.sqrt(7)
    if fallback:
        safety = np.where(np.isnan(safety), 0.2 * demand, safety)
    use = (sold.sum(axis=1) >= least_rows) & (n > 0)
    return pd.DataFrame({"demand": demand, "safety": safety, "restock": demand + safety, "price": paid}, index=codes)[use]


def _compare(got: pd.DataFrame, exp: pd.DataFrame, predict: bool) -> None:
    got = got.set_index("StockCode")
    assert set(got.index) == set(exp.index) and len(got) == len(exp)
    got = got.loc[exp.index]
    for c, e in (("predicted_weekly_demand", "demand"), ("safety_stock", "safety"), ("recommended_restock", "restock")):
        g = got[c].to_numpy(float)
        assert (np.isnan(g) == np.isnan(exp[e])).all(), c
        assert (np.isnan(g) | ((g == np.rint(g)) & (np.abs(g - exp[e]) <= 0.5 + 1e-9))).all(), c
    r = got.recommended_restock.to_numpy(float)
    cost = exp.restock * exp.price if predict else r * exp.price
    assert np.allclose(got.estimated_cost.to_numpy(float), cost, rtol=1e-9, atol=0.0051 if predict else 1e-9, equal_nan=True)
    low, high = np.percentile(r[~np.isnan(r)], [1 / 3 * 100, 2 / 3 * 100])
    label = np.where(np.isnan(r), None, np.where(r <= low, "Low", np.where(r <= high, "Medium", "High")))
    assert [x if isinstance(x, str) else None for x in got.priority] == list(label)


@pytest.mark.parametrize("name", ["restock_recommendations", "restock_training"])
def test_restock_equals_array_formulas(spark, name):
    import __spark_entry__ as E
    predict = name == "restock_recommendations"
    exp = _expected(_sales(), PREDICT.min_rows if predict else TRAINING.min_rows, predict)
    _compare(E.queries()[name](spark, SF_SMALL).toPandas(), exp, predict)


def test_hot_product_third_of_rows(spark):
    """One product holds a third of all lines: results stay whole and exact."""
    from stockcast.operators.clean import clean_sales
    from stockcast.operators.features import engineer_features

    rng = np.random.default_rng(7)
    start = np.datetime64("2024-01-01")
    hot = [(f"{i}", "HOT", "hot item", float(rng.integers(1, 20)), start + int(rng.integers(0, 60)), 2.5) for i in range(1200)]
    rest = [(("C" if j % 17 == 0 else "") + f"{p}{j}", f"P{p:02d}", f"item {p}", float(rng.integers(-3, 30)),
             start + int(rng.integers(0, 60)), 1.0 + p) for p in range(48) for j in range(50)]
    pdf = pd.DataFrame(hot + rest, columns=["Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price"])
    sdf = spark.createDataFrame(pdf.assign(InvoiceDate=pdf.InvoiceDate.astype(str)))
    sdf = sdf.withColumn("InvoiceDate", sdf.InvoiceDate.cast("timestamp_ntz"))
    feats = engineer_features(clean_sales(sdf, PREDICT), PREDICT)
    got = restock_recommendations(feats, PREDICT, baseline_scorer).toPandas()
    assert "HOT" in set(got.StockCode)
    _compare(got, _expected(pdf, PREDICT.min_rows, True), True)


def test_a_scorer_is_required(spark):
    with pytest.raises(TypeError):
        restock_recommendations(spark.range(1), PREDICT)
