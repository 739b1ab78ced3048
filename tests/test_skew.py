"""Hot keys by sketch, and rows with repeated keys, without moving the rows."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from samekin.operators import skew
from samekin.operators.pairs import one_row_per_id, one_row_per_key, repeated_keys


def plan_of(df):
    """The final plan, after it ran."""
    df.collect()
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def hashes(spark, *values):
    table = spark.createDataFrame([(v,) for v in values], "k long")
    return {r[0] for r in table.select(F.xxhash64("k")).collect()}


def test_a_third_of_all_rows_under_one_key(spark):
    rows = spark.range(0, 300_000, 1, 13).select(
        F.when(F.col("id") % 3 == 0, F.lit(-7)).when(F.col("id") % 10 == 1, F.lit(-8)).otherwise(F.col("id")).alias("k")
    )
    assert set(skew.hot_keys(rows, "k", 50_000)) == hashes(spark, -7)
    assert set(skew.hot_keys(rows, ["k"], 10_000)) == hashes(spark, -7, -8)
    assert skew.hot_keys(rows, "k", 200_000) is None


def test_no_rows_and_no_keys(spark):
    empty = spark.range(0).toDF("k")
    assert skew.hot_keys(empty, "k", 0) is None
    nulls = spark.range(9).select(F.lit(None).cast("long").alias("k"))
    assert skew.hot_keys(nulls, "k", 0) is None


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hot_and_cold_rows_join_alike(spark, how):
    rows = spark.range(3_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 50 == 2, F.lit(None)).otherwise(F.col("id") % 40).alias("k"),
        F.col("id").alias("v"),
    )
    lookup = spark.range(0, 60, 2).select((F.col("id") + 1).alias("k"), F.col("id").alias("w"))
    hot = skew.hot_keys(rows, "k", 500)
    assert set(hot) == hashes(spark, 1)
    found = skew.lookup_join(rows, lookup, "k", how, hot)
    assert sorted(map(str, found.collect())) == sorted(map(str, rows.join(lookup, "k", how).collect()))


def test_unique_ids_are_not_moved(spark):
    rows = spark.range(500).select(F.col("id").cast("string").alias("txId"), F.rand(1).alias("amount"))
    plan = plan_of(one_row_per_id(rows).where("txId is not null"))
    assert "SortAggregate" not in plan and "Exchange hashpartitioning" not in plan
    assert one_row_per_id(rows).count() == 500


def test_repeated_ids_keep_the_smallest_row(spark):
    rows = [("a", 2, "x"), ("a", 1, "y"), ("b", 3, "z"), ("a", 1, "x"), (None, 5, "n"), (None, 4, "n"), ("c", None, "q")]
    table = spark.createDataFrame(rows, "txId string, n int, t string")
    found = {tuple(r) for r in one_row_per_id(table).collect()}
    assert found == {("a", 1, "x"), ("b", 3, "z"), (None, 4, "n"), ("c", None, "q")}
    by_two = one_row_per_key(table, ["txId", "t"], ["n"]).collect()
    assert {tuple(r) for r in by_two} == {r for r in rows if r not in [("a", 2, "x"), (None, 5, "n")]}
    assert one_row_per_id(table.limit(0)).collect() == []


def test_ids_that_mostly_repeat_are_moved_once(spark, monkeypatch):
    """Without a join, if the repeated ones are too many to be broadcast."""
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 5)
    rows = spark.range(100).select((F.col("id") % 50).cast("string").alias("txId"), F.col("id").alias("n"))
    merged = one_row_per_id(rows)
    assert "Join" not in plan_of(merged)
    assert sorted(r["n"] for r in merged.collect()) == list(range(50))


def test_unique_keys_of_equal_hashes_stay_rows_of_their_own(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("c", 4), (None, 5)], "txId string, n int")
    repeated = repeated_keys(rows, ["txId"])
    assert repeated.rows == 1
    # As if those of a and of the null were found twice.
    every = skew.measured(rows.select(F.xxhash64("txId").alias("_hash"), F.lit(2).alias("_rows")).distinct())
    found = one_row_per_id(rows, every)
    assert sorted(r["n"] for r in found.collect()) == [1, 2, 4, 5]
