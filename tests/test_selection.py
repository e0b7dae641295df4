"""Exact order statistics by sketch brackets equal NumPy and pandas, with few rows shuffled."""

import math
import random

import numpy as np
import pandas as pd
import pytest

from stockcast.functions import selection as S

QS = [0.25, 0.5, 0.75, 1 / 3, 2 / 3, 0.0, 1.0, 0.013]


def columns_of(n, seed=1):
    rng = np.random.default_rng(seed)
    hot = rng.choice([5.0, 5.0, 7.0, 1e9, -3.5], n)
    return {"normal": rng.normal(100, 30, n), "hot": hot, "money": rng.integers(0, 10 ** 5, n) / 100, "wide": np.exp(rng.normal(0, 5, n)) * rng.choice([-1, 1], n)}


@pytest.mark.parametrize(("n", "limit"), [(1, 100_000), (2, 100_000), (700, 4), (3000, 100_000), (20_000, 2000)])
def test_quantiles_equal_numpy(spark, monkeypatch, n, limit):
    monkeypatch.setattr(S, "LIMIT", limit)
    monkeypatch.setattr(S, "SKETCH_K", 400)
    data = columns_of(n)
    pdf = pd.DataFrame(data)
    df = spark.createDataFrame(pdf).repartition(5)
    for name, got in S.select(df, list(data), QS).items():
        x = np.sort(data[name])
        assert got.n == n and (got.lowest, got.highest) == (x[0], x[-1])
        want = [x[math.floor((n - 1) * q)] if (n - 1) * q == math.floor((n - 1) * q) else None for q in QS]
        for g, q, w in zip(got.quantiles, QS, want, strict=True):
            assert math.isclose(g, np.percentile(x, q * 100), rel_tol=1e-12, abs_tol=1e-12) and (w is None or g == w)
        assert math.isclose(got.mean, math.fsum(x) / n, rel_tol=1e-14)
        assert got.std is None if n == 1 else math.isclose(got.std, np.std(x, ddof=1), rel_tol=1e-12)


def test_a_sketch_that_misses_is_found_out(spark, monkeypatch):
    rng = random.Random(3)
    data = [float(rng.randrange(10 ** 6)) for _ in range(4000)]
    df = spark.createDataFrame([(x,) for x in data], "x double")
    cuts = S._cuts
    wrong = {"left": 3}

    def misleading(df, sketch, shares):
        out = cuts(df, sketch, shares)
        if wrong["left"]:
            wrong["left"] -= 1
            return [out[0] - 1.0 if k % 2 == 0 else out[0] for k in range(len(out))]  # all brackets at the low end
        return out
    monkeypatch.setattr(S, "_cuts", misleading)
    got = S.select(df, ["x"], [0.5, 0.9])["x"]
    assert got.quantiles == [np.percentile(data, 50), np.percentile(data, 90)]


def test_missing_values_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (float("nan"), None), (3.0, float("nan"))], "a double, b double")
    got = S.select(df, ["a", "b"], [0.5])
    assert (got["a"].n, got["a"].quantiles, got["b"].n, got["b"].quantiles, got["b"].std) == (2, [2.0], 0, [None], None)
    assert S.select(df.filter("false"), ["a"], [0.5, 1.0])["a"].quantiles == [None, None]


def test_rows_that_reach_the_driver_do_not_grow_with_the_distinct_values(spark, monkeypatch):
    monkeypatch.setattr(S, "LIMIT", 2000)
    held = []
    count = S._count

    def counting(*args):
        out = count(*args)
        held.append(sum(map(len, out[0].values())))
        return out
    monkeypatch.setattr(S, "_count", counting)
    n = 300_000
    got = S.select(spark.range(n).selectExpr("cast((id * 7919) % 300007 as double) x"), ["x"], [0.25, 0.5])["x"]
    x = np.sort(np.arange(n) * 7919 % 300007)
    assert got.quantiles == [np.percentile(x, 25), np.percentile(x, 50)]
    assert len(held) == 1 and held[0] < 2100


def test_an_order_statistic_sums_no_squares(spark):
    # squares of these, like those of many hash numbers, are beyond a decimal of 38 digits
    df = spark.createDataFrame([(x,) for x in (3e25, 1e25, 2e25, None, 2e25)], "x double")
    assert [S.order_statistic(df, "x", k) for k in range(4)] == [(4, 1e25, 0), (4, 2e25, 1), (4, 2e25, 1), (4, 3e25, 3)]
