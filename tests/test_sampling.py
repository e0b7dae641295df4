"""Sampling and splitting by order statistic: exact counts, any partitioning, no gathered rows."""

import hashlib

import pytest
from pyspark.sql import functions as F

from stockcast.operators.sample import sample_rows, train_test_split_exact


def md5(*values):
    return hashlib.md5("|".join([*map(str, values), "42"]).encode()).hexdigest()


@pytest.mark.parametrize("n", [1, 500, 4999])
def test_sample_is_the_n_smallest_hashes(spark, n):
    df = spark.range(5000).selectExpr("id", "id % 7 as g")
    got = {tuple(r) for r in sample_rows(df.repartition(3), n).collect()}
    want = sorted(((i, i % 7) for i in range(5000)), key=lambda r: md5(*r))[:n]
    assert got == set(want)
    assert got == {tuple(r) for r in sample_rows(df.repartition(11), n).collect()}


def test_sample_sizes_at_the_ends(spark):
    df = spark.range(20)
    assert [sample_rows(df, n).count() for n in (0, 19, 20, 21)] == [0, 19, 20, 20]
    assert sample_rows(df.filter("false"), 5).count() == 0


def test_sample_of_a_row_that_repeats(spark):
    df = spark.range(9000).selectExpr("if(id % 3 = 0, -1, id) as id", "cast(null as string) as s")
    for n in (10, 2500, 6500):
        got = sample_rows(df, n)
        assert got.count() == n and got.where("id >= 0").distinct().count() == got.where("id >= 0").count()
        assert got.where("id = -1").count() <= 3000


def test_a_large_sample_sorts_and_gathers_nothing(spark):
    got = sample_rows(spark.range(300_000).selectExpr("id", "id * 3 as b"), 200_000)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "GlobalLimit" not in plan and "rangepartitioning" not in plan
    assert got.count() == got.select("id").distinct().count() == 200_000


@pytest.mark.parametrize("n", [1, 2, 5, 1001])
def test_split_has_exact_counts(spark, n):
    df = spark.range(n).selectExpr("cast(id as string) as StockCode", "date_add(date'2020-01-01', cast(id % 9 as int)) as Date", "id as x")
    parts = {r.split: r["count"] for r in train_test_split_exact(df.repartition(4)).groupBy("split").count().collect()}
    assert parts.get("test", 0) == -(-n // 5) and sum(parts.values()) == n
    again = {(r.x, r.split) for r in train_test_split_exact(df.repartition(9)).collect()}
    assert again == {(r.x, r.split) for r in train_test_split_exact(df).collect()}


def test_split_of_rows_that_share_their_key(spark):
    df = spark.range(1000).select(F.lit("A").alias("StockCode"), F.lit("d").alias("Date"), F.col("id"))
    assert train_test_split_exact(df).where("split = 'test'").count() == 200
