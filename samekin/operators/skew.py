"""Joins of row tables to per-key lookups that hold up when one key has a large share of rows.

A key is *hot* when it has more than ``HOT_ROWS`` rows and is among the ``MAX_HOT_KEYS`` most frequent
ones that a sketch of frequent items tells. The sketch is made in one pass over the rows where they lie;
only sketches are moved, whose size is fixed. It finds every key with more than about a
``1 / SKETCH_ITEMS`` of all rows. A key left out is shuffled by an ordinary join, whose large partitions
adaptive execution splits. Keys go by a 64-bit hash: should a cold key share that of a hot one, it takes
the hot one's way, which gives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from samekin.session import scratch_path

MAX_HOT_KEYS = 1024
HOT_ROWS = 1_000_000
# Items that a sketch keeps track of, and in how many groups sketches are merged first.
SKETCH_ITEMS = 8192
SKETCH_GROUPS = 64

# A lookup is broadcast as a whole only below both bounds, measured on the lookup itself.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 16 * 1024 * 1024


def _columns(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else key


def hot_keys(
    rows: DataFrame, key: str | list[str], hot_rows: int = HOT_ROWS
) -> list[int] | None:
    """The hashes of the hot values of ``key``, at most ``MAX_HOT_KEYS``, or None."""
    columns = _columns(key)
    hashed = rows.dropna("any", subset=columns).select(F.xxhash64(*columns).alias("_key"))
    group = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_group")
    merged = (
        hashed.groupBy(group)
        .agg(F.expr(f"approx_top_k_accumulate(_key, {SKETCH_ITEMS})").alias("_sketch"))
        .groupBy(F.lit(1))
        .agg(F.expr(f"approx_top_k_combine(_sketch, {SKETCH_ITEMS})").alias("_sketch"))
    )
    told = merged.select(F.expr(f"approx_top_k_estimate(_sketch, {MAX_HOT_KEYS})").alias("top")).first()
    return [r["item"] for r in told["top"] if r["count"] > hot_rows] or None if told else None


def _is_hot(key: str | list[str], hot: list[int]) -> Column:
    return F.xxhash64(*_columns(key)).isin(hot)


def lookup_join(
    rows: DataFrame, lookup: DataFrame, key: str | list[str], how: str, hot: list[int] | None
) -> DataFrame:
    """Join ``rows`` to ``lookup``, which has one row per key, without shuffling hot keys.

    Rows with a hot key meet a broadcast of the few matching lookup rows where they are; the
    rest take an ordinary shuffle join.
    """
    if hot is None:
        return rows.join(lookup, key, how)
    is_hot = _is_hot(key, hot)
    hot_part = rows.where(is_hot).join(F.broadcast(lookup.where(is_hot)), key, how)
    cold_part = rows.where(~is_hot).join(lookup.where(~is_hot), key, how)
    return hot_part.unionByName(cold_part)


@dataclass
class Lookup:
    """A lookup table in the shared folder, measured there."""

    table: DataFrame
    rows: int
    bytes: int

    @property
    def small(self) -> bool:
        """Whether it may be broadcast as a whole."""
        return self.rows <= BROADCAST_ROWS and self.bytes <= BROADCAST_BYTES


def measured(lookup: DataFrame) -> Lookup:
    """Compute ``lookup`` once, into the shared folder."""
    path = scratch_path(lookup.sparkSession, "lookup")
    lookup.write.parquet(path)
    table = lookup.sparkSession.read.schema(lookup.schema).parquet(path)
    texts = [f.name for f in lookup.schema if f.dataType.typeName() == "string"]
    width = sum((F.coalesce(F.octet_length(t), F.lit(0)) for t in texts), F.lit(8 * len(lookup.columns)))
    count, size = table.agg(F.count("*"), F.sum(width)).first()
    return Lookup(table, count, size or 0)


def sized_join(
    rows: DataFrame,
    lookup: DataFrame | Lookup,
    key: str | list[str],
    how: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Like :func:`lookup_join`, for a lookup that is usually tiny and is :func:`measured`. Within the
    broadcast bounds it is broadcast as a whole, and ``rows`` are not shuffled."""
    known = lookup if isinstance(lookup, Lookup) else measured(lookup)
    if known.small:
        return rows.join(F.broadcast(known.table), key, how)
    return lookup_join(rows, known.table, key, how, hot_keys(rows, key, hot_rows))


Keep = Callable[[DataFrame], DataFrame]


@contextmanager
def reused() -> Iterator[Keep]:
    """Gives a function that persists what is read several times; all is released at the end, so
    whatever consumes it has to run inside."""
    kept: list[DataFrame] = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return kept[-1]

    try:
        yield keep
    finally:
        for df in kept:
            df.unpersist()


def recomputed(df: DataFrame) -> DataFrame:
    """The alternative to keeping: read it again from its source each time."""
    return df
