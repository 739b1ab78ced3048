"""Candidate pairs: ordered self-joins inside blocks, and their union over passes."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samekin.operators.blocking import (
    BLOCK,
    BlockingPass,
    first_pass_only,
    pass_key,
    per_pass,
    with_pass_keys,
)
from samekin.operators.skew import Lookup, measured, sized_join

# A block of more rows is joined in tiles of this many rows a side, each tile by its own, so that a
# tile makes no more pairs than a task should.
TILE_ROWS = 4_000
# One task makes about this many pairs, and reads about this many rows.
PAIRS_PER_TASK = 20_000_000
ROWS_PER_TASK = 2_000_000
MAX_PARTITIONS = 100_000
# Rows are all merged at once if there is a repeated key for less than so many of them.
MOSTLY = 8


def _columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if not c.startswith("_") and c != "blockKey"]


def _tiled(rows: DataFrame, key: list[str], sizes: DataFrame, tile_rows: int) -> DataFrame:
    """``rows`` with the tile each row falls in and the number of tiles of its block."""
    large = sizes.where(F.col("_rows") > tile_rows).select(
        *key, F.ceil(F.col("_rows") / tile_rows).cast("int").alias("_tiles")
    )
    tiles = F.coalesce(F.col("_tiles"), F.lit(1))
    tiled = sized_join(rows, large, key, "left").withColumn("_tiles", tiles)
    return tiled.withColumn("_tile", F.pmod(F.xxhash64("txId"), F.col("_tiles")).cast("int"))


def self_join(
    rows: DataFrame, key: list[str], tile_rows: int, condition: Column | None = None
) -> DataFrame:
    """All pairs (``l``, ``r``) of rows with equal ``key`` and ``l.txId < r.txId`` as strings,
    as far as they meet ``condition``.

    An equi-join on the key, in as many partitions as the numbers of rows and of pairs ask for; the
    bytes shuffled would say little about the latter. A block larger than ``tile_rows`` becomes several
    smaller joins on (key, left tile, right tile), so no task holds a whole large block.
    """
    rows = rows.dropna("any", subset=key)
    sizes = rows.groupBy(*key).agg(F.count("*").alias("_rows"))
    n = F.col("_rows").cast("double")
    largest, members, pairs = sizes.agg(
        F.max("_rows"), F.sum("_rows"), F.sum(n * (n - 1.0) / 2.0)
    ).first()
    equal = list(key)
    if (largest or 0) <= tile_rows:
        left, right = rows, rows
    else:
        tiled = _tiled(rows, key, sizes, tile_rows)
        others = F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1))
        left = tiled.withColumn("_ltile", F.col("_tile")).withColumn("_rtile", others)
        right = tiled.withColumn("_rtile", F.col("_tile")).withColumn("_ltile", others)
        equal += ["_ltile", "_rtile"]
    usual = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    needed = max((pairs or 0.0) / PAIRS_PER_TASK, (members or 0) / ROWS_PER_TASK)
    partitions = max(usual, min(MAX_PARTITIONS, math.ceil(needed)))
    left, right = left.repartition(partitions, *equal), right.repartition(partitions, *equal)
    on = F.col("l.txId") < F.col("r.txId")
    for column in equal:
        on &= F.col(f"l.{column}") == F.col(f"r.{column}")
    if condition is not None:
        on &= condition
    return left.alias("l").join(right.alias("r"), on)


def _side(alias: str, columns: list[str]) -> Column:
    return F.struct(*[F.col(f"{alias}.{c}") for c in columns])


def repeated_keys(rows: DataFrame, key: list[str]) -> Lookup:
    """The hashes (``_hash``) that more than one row's key has, with how many rows (``_rows``). Nothing but
    the keys is looked at. Different keys may share a hash; a key that is not told has one row."""
    hashed = rows.select(F.xxhash64(*key).alias("_hash")).groupBy("_hash")
    return measured(hashed.agg(F.count("*").alias("_rows")).where("_rows > 1"))


def one_row_per_key(
    rows: DataFrame, key: list[str], smallest_by: list[str], repeated: Lookup | None = None
) -> DataFrame:
    """Rows that agree in ``key`` as one, the smallest of them by ``smallest_by``.

    Only the keys' hashes are looked at to find those that repeat; rows are moved for these alone, and if
    there are none, ``rows`` come back as they are. Where most keys repeat, so that the hashes are too many
    to be broadcast, all rows are moved, once. A null is a key like others.
    """
    repeated = repeated or repeated_keys(rows, key)
    if not repeated.rows:
        return rows
    others = [c for c in rows.columns if c not in key and c not in smallest_by]

    def merged(again: DataFrame) -> DataFrame:
        one = again.groupBy(*key).agg(F.min(F.struct(*smallest_by, *others)).alias("_one"))
        back = [F.col(f"_one.{c}").alias(c) for c in [*smallest_by, *others]]
        return one.select(*key, *back).select(*rows.columns)

    if not repeated.small and repeated.rows * MOSTLY > rows.count():
        return merged(rows)
    keyed = rows.withColumn("_hash", F.xxhash64(*key))
    again = sized_join(keyed, repeated, "_hash", "left_semi").select(*rows.columns)
    single = sized_join(keyed, repeated, "_hash", "left_anti").select(*rows.columns)
    return single.unionByName(merged(again))


def one_row_per_id(transactions: DataFrame, repeated: Lookup | None = None) -> DataFrame:
    """Rows with the same id, such as exact copies under a content id, as one: the smallest of them.
    A row has no pair with itself, and a pair of ids is one pair."""
    others = [c for c in transactions.columns if c != "txId"]
    return one_row_per_key(transactions, ["txId"], others, repeated)


def candidate_pairs(blocked: DataFrame, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Every unordered pair of rows of a block once, as ``left``, ``right``, ``blockKey``."""
    columns = _columns(blocked)
    return self_join(blocked, ["blockKey"], tile_rows).select(
        _side("l", columns).alias("left"),
        _side("r", columns).alias("right"),
        F.col("l.blockKey").alias("blockKey"),
    )


def union_and_deduplicate(*pair_sets: DataFrame) -> DataFrame:
    """Union of pair sets with one row per unordered pair of ids. The survivor is the one with
    the smallest block key, so the result does not depend on the order of rows."""
    union = pair_sets[0]
    for other in pair_sets[1:]:
        union = union.unionByName(other)
    ids = [F.col("left.txId"), F.col("right.txId")]
    keyed = union.withColumns({"_low": F.least(*ids), "_high": F.greatest(*ids)})
    return one_row_per_key(keyed, ["_low", "_high"], ["blockKey", "left", "right"]).select(
        "left", "right", "blockKey"
    )


def _found_by(shared: list[Column], passes: tuple[BlockingPass, ...]) -> Column:
    """The names of the passes whose key is ``shared``, in their order. Two passes' arrays are constants,
    and a few are put together; filtering an array by a function would take the join out of generated code."""
    none = F.array().cast("array<string>")

    def named(chosen: tuple[BlockingPass, ...]) -> Column:
        return F.array(*[F.lit(p.name) for p in chosen]) if chosen else none

    parts = []
    for at in range(0, len(passes), 2):
        some, keys = passes[at : at + 2], shared[at : at + 2]
        part = F.when(reduce(lambda x, y: x & y, [k.isNotNull() for k in keys]), named(some))
        if len(some) > 1:
            for key, one in zip(keys, some):
                part = part.when(key.isNotNull(), named((one,)))
        parts.append(part.otherwise(none))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def multi_pass_pairs(
    transactions: DataFrame, passes: tuple[BlockingPass, ...], tile_rows: int = TILE_ROWS
) -> DataFrame:
    """Deduplicated pairs over all passes, with the names of the passes that found each.

    Ids must be unique (:func:`one_row_per_id`). A pair is emitted by the first pass that has it and suppressed in
    later ones, so the pairs, the largest data there is, are not shuffled again to be
    deduplicated. ``blockKey`` is the smallest of the keys the pair shares.
    """
    keyed = with_pass_keys(transactions, passes)
    columns = _columns(keyed)
    keys = [pass_key(i) for i in range(len(passes))]
    shared = [F.when(F.col(f"l.{k}") == F.col(f"r.{k}"), F.col(f"l.{k}")) for k in keys]
    exploded = per_pass(keyed, list(range(len(passes))))
    return self_join(exploded, BLOCK, tile_rows, first_pass_only(passes)).select(
        _side("l", columns).alias("left"),
        _side("r", columns).alias("right"),
        (F.least(*shared) if len(shared) > 1 else shared[0]).alias("blockKey"),
        _found_by(shared, passes).alias("passes"),
    )
