"""Blocking: group transactions by a key so that only rows of one group are compared."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samekin.functions.text import NOT_A_LETTER, PREFIX_LENGTH, normalize_name
from samekin.operators.skew import sized_join


def prefix_key(name: str = "name") -> Column:
    """First letters of the normalized name."""
    letters = F.regexp_replace(normalize_name(F.col(name)), NOT_A_LETTER, "")
    return F.substring(letters, 1, PREFIX_LENGTH)


def exact_name_key(name: str = "name") -> Column:
    """The name itself, lower case and without outer spaces."""
    return F.lower(F.trim(F.col(name)))


def amount_type_key(amount: str = "amount", tx_type: str = "txType") -> Column:
    """Amount in cents and the type as written."""
    cents = F.round(F.col(amount) * 100.0, 0).cast("long").cast("string")
    return F.concat(F.lit("amt:"), cents, F.lit("|type:"), F.col(tx_type))


@dataclass(frozen=True)
class BlockingPass:
    """One way to form blocks.

    ``max_block_size``, if the caller sets one, drops larger blocks from this pass; the passes below
    have none, whatever a block's size. ``same_name`` promises that all rows
    of a block have the same normalized name.
    """

    name: str
    key: Callable[[], Column]
    max_block_size: int | None = None
    same_name: bool = False


NAME_PASS = BlockingPass("exact_name", exact_name_key, same_name=True)
AMOUNT_PASS = BlockingPass("amount_type", amount_type_key)
PREFIX_PASS = BlockingPass("name_prefix", prefix_key)
DEFAULT_PASSES = (NAME_PASS, AMOUNT_PASS)


def block(transactions: DataFrame, key: Column) -> DataFrame:
    """Add ``blockKey``. A null key stays in the table but never forms a pair."""
    return transactions.withColumn("blockKey", key)


def block_sizes(blocked: DataFrame) -> DataFrame:
    return blocked.groupBy("blockKey").agg(F.count("*").alias("count"))


def oversized_blocks(blocked: DataFrame, max_block_size: int) -> DataFrame:
    keyed = blocked.where(F.col("blockKey").isNotNull())
    return block_sizes(keyed).where(F.col("count") > max_block_size).select("blockKey")


def cap_blocks(blocked: DataFrame, max_block_size: int) -> DataFrame:
    """Drop every block of more than ``max_block_size`` rows, and rows without a key.

    The few oversized keys are looked up rather than the many allowed ones, so the rows
    themselves normally need no shuffle.
    """
    keyed = blocked.where(F.col("blockKey").isNotNull())
    return sized_join(keyed, oversized_blocks(blocked, max_block_size), "blockKey", "left_anti")


def sub_block(blocked: DataFrame, max_block_size: int, sub_key: Column) -> DataFrame:
    """Split blocks of more than ``max_block_size`` rows by a second key. No row is lost, but pairs
    across second keys are: a tool to look at blocks, not a pass to resolve entities with."""
    keyed = blocked.where(F.col("blockKey").isNotNull()).withColumn("_sub", sub_key.cast("string"))
    marked = oversized_blocks(blocked, max_block_size).withColumn("_large", F.lit(True))
    joined = sized_join(keyed, marked, "blockKey", "left")
    split = F.concat(F.col("blockKey"), F.lit("|sub:"), F.coalesce(F.col("_sub"), F.lit("")))
    key = F.when(F.col("_large"), split).otherwise(F.col("blockKey"))
    return joined.withColumn("blockKey", key).drop("_large", "_sub").select(*blocked.columns)


def pass_key(index: int) -> str:
    return f"_key{index}"


def with_pass_keys(transactions: DataFrame, passes: tuple[BlockingPass, ...]) -> DataFrame:
    """Add one key column per pass (``_key0``, ``_key1``, ...). A row in an oversized block of a
    capped pass gets a null key there, which takes it out of that pass only."""
    keyed = transactions
    for index, blocking in enumerate(passes):
        keyed = keyed.withColumn(pass_key(index), blocking.key())
    for index, blocking in enumerate(passes):
        if blocking.max_block_size is not None:
            name = pass_key(index)
            blocked = transactions.select(blocking.key().alias("blockKey"))
            large = oversized_blocks(blocked, blocking.max_block_size).select(
                F.col("blockKey").alias(name), F.lit(True).alias("_large")
            )
            order = keyed.columns
            keyed = sized_join(keyed, large, name, "left")
            keyed = keyed.withColumn(name, F.when(F.col("_large").isNull(), F.col(name)))
            keyed = keyed.select(*order)
    return keyed


# Where a row stands after ``per_pass``.
BLOCK = ["_pass", "_block"]


def per_pass(keyed: DataFrame, indexes: list[int]) -> DataFrame:
    """One row per transaction and pass it has a key in, with ``_pass`` and ``_block``, so that
    all passes go through one join or aggregation instead of one each."""
    blocks = F.array(
        *[F.struct(F.lit(i).alias("pass"), F.col(pass_key(i)).alias("block")) for i in indexes]
    )
    exploded = keyed.withColumn("_in", F.explode(blocks)).where(F.col("_in.block").isNotNull())
    return exploded.withColumns(
        {"_pass": F.col("_in.pass"), "_block": F.col("_in.block")}
    ).drop("_in")


def first_pass_only(passes: tuple[BlockingPass, ...]) -> Column:
    """Condition on a pair ``l``, ``r`` that lets only the first pass with a shared key have it."""
    condition = F.lit(True)
    for index in range(len(passes) - 1):
        key = pass_key(index)
        shared = F.coalesce(F.col(f"l.{key}") == F.col(f"r.{key}"), F.lit(False))
        condition &= (F.col("l._pass") <= index) | ~shared
    return condition
