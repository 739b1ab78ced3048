"""Shards of nearly equal bytes by histogram sort.

The rows are ordered by a key, the hash of the text and then of the id, so that copies of a text
lie side by side and a group of copies of any size can still be cut. Splitters are found by
counting: the exact bytes below a set of candidate boundaries are summed over all partitions,
boundaries that miss their target get new probes between the two nearest counted ones, until
every splitter is within tolerance. The rows are then exchanged once.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from samekin.llm.store import set_aside, written

# A row's size is the bytes of its text and this much for its id.
ROW_BYTES = 8
# How far a shard's first byte may be from its place, as a share of a shard.
TOLERANCE = 0.0005
# Shards are exchanged in pieces of about this size, so that no task sorts a whole shard.
PIECE_BYTES = 8 << 20
# Probes a round and open splitter between shards, and the most pieces there are.
PROBES = 32
MAX_PIECES = 1 << 16
MAX_ROUNDS = 64
_DIGITS = 32
_COUNTED = "bucket int, size long, rows long, low string, high string"


def _text(number: int) -> str:
    return f"{number:0{_DIGITS}x}"


def with_sort_key(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Add ``_size`` and ``_key``, 32 hexadecimal digits."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    parts = [
        F.lower(F.lpad(F.hex(F.xxhash64(*columns)), _DIGITS // 2, "0"))
        for columns in ((text, F.col(text_column).isNull()), (F.col(id_column), F.lit(17)))
    ]
    return docs.withColumns(
        {"_size": F.octet_length(text).cast("long") + ROW_BYTES, "_key": F.concat(*parts)}
    )


def count_below(keyed: DataFrame, bounds: list[str]) -> list[tuple]:
    """Bytes, rows, smallest and largest key between neighbouring boundaries, where there are
    rows: a row for each such bucket, over all partitions."""
    held = np.array(bounds, f"S{_DIGITS}")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("_key").to_numpy(zero_copy_only=False).astype(f"S{_DIGITS}")
            sizes = batch.column("_size").to_numpy(zero_copy_only=False)
            order = np.argsort(keys, kind="stable")
            keys, sizes = keys[order], sizes[order]
            buckets = np.searchsorted(held, keys, "right")
            starts = np.flatnonzero(np.diff(buckets, prepend=-1))
            ends = np.append(starts[1:], len(keys))
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array(buckets[starts], pa.int32()),
                    "size": pa.array(np.add.reduceat(sizes, starts), pa.int64()),
                    "rows": pa.array(ends - starts, pa.int64()),
                    "low": pa.array([k.decode() for k in keys[starts]]),
                    "high": pa.array([k.decode() for k in keys[ends - 1]]),
                }
            )

    return (
        keyed.select("_key", "_size")
        .mapInArrow(counted, _COUNTED)
        .groupBy("bucket")
        .agg(F.sum("size"), F.sum("rows"), F.min("low"), F.max("high"))
        .collect()
    )


@dataclass
class _Gap:
    """What is known between two counted boundaries: the bytes below, its own bytes and rows, and
    the smallest and largest key in it."""

    below: int
    size: int
    rows: int
    low: int
    high: int


def _probes(gap: _Gap, target: int, count: int) -> set[int]:
    """Candidate boundaries inside ``gap``: where a uniform hash puts the target, give or take what
    chance allows for, and the middle."""
    span = gap.high - gap.low
    expected = gap.low + span * (target - gap.below) // gap.size
    reach = max(1, 3 * span // max(1, math.isqrt(gap.rows)))
    at = [expected - reach + 2 * reach * j // (count - 1) for j in range(count)]
    return {min(max(a, gap.low + 1), gap.high) for a in [*at, gap.low + span // 2 + 1]}


def find_splitters(keyed: DataFrame, total: int, targets: list[tuple[int, int]]) -> list[str]:
    """A key for each of ``targets``, ascending pairs of bytes below and tolerance in bytes: as
    many bytes lie below the key as wanted, give or take the tolerance or, where a single key has
    more bytes than that, to the nearer edge of that key."""
    fewest = min((t for _, t in targets), default=0)
    gaps = [_Gap(0, r[1], r[2], int(r[3], 16), int(r[4], 16)) for r in count_below(keyed, [])]
    chosen: dict[int, int] = {}
    for _ in range(MAX_ROUNDS):
        starts = [g.below for g in gaps]
        tried: set[int] = set()
        for i, (target, tolerance) in enumerate(targets):
            if i in chosen:
                continue
            gap = gaps[bisect.bisect_right(starts, target) - 1]
            edges = [(gap.below, gap.low), (gap.below + gap.size, gap.high + 1)]
            off, key = min((abs(below - target), key) for below, key in edges)
            if off <= tolerance or gap.low == gap.high:
                chosen[i] = key
            else:
                tried |= _probes(gap, target, PROBES if tolerance == fewest else 3)
        if len(chosen) == len(targets):
            return [_text(chosen[i]) for i in range(len(targets))]
        # Old edges stay boundaries, so that every count is exact.
        bounds = sorted(tried | {g.low for g in gaps[1:]})
        below, gaps = 0, []
        for _, size, rows, low, high in sorted(count_below(keyed, [_text(b) for b in bounds])):
            gaps.append(_Gap(below, size, rows, int(low, 16), int(high, 16)))
            below += size
        gaps = _merged(gaps, [t for i, (t, _) in enumerate(targets) if i not in chosen])
    raise RuntimeError("splitters did not settle")


def _merged(gaps: list[_Gap], targets: list[int]) -> list[_Gap]:
    """Neighbours that no open target lies in are counted as one from now on."""
    kept: list[_Gap] = []
    starts = [g.below for g in gaps]
    wanted = {bisect.bisect_right(starts, t) - 1 for t in targets}
    for i, gap in enumerate(gaps):
        if kept and i not in wanted and (i - 1) not in wanted:
            last = kept[-1]
            kept[-1] = _Gap(
                last.below, last.size + gap.size, last.rows + gap.rows, last.low, gap.high
            )
        else:
            kept.append(gap)
    return kept


def histogram_shards(
    docs: DataFrame,
    shards: int = 24,
    id_column: str = "doc_id",
    text_column: str = "text",
    tolerance: float = TOLERANCE,
    piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """``docs`` with ``shard`` and ``slot``: shards 0 to ``shards - 1`` of nearly equal bytes
    (text plus ``ROW_BYTES`` a row), slots gapless from 0 in the order of the key.

    A null text counts no bytes. Equal texts lie side by side; only a splitter can part them.
    Rows equal in id and text share a key and stay in one shard. No rows give no rows. Columns of
    ``docs`` that are called like the new ones are replaced.

    The keys, 40 bytes a row, are written once to the shared folder and counted from there. The
    driver holds a bounded number of splitters. A shard is exchanged in pieces of about
    ``piece_bytes``, more if there would be over ``MAX_PIECES`` pieces.
    """
    plain, back = set_aside(docs.drop("shard", "slot"), {"_key", "_size", "_piece", "_rank", "_before"})
    full = with_sort_key(plain, id_column, text_column)
    keyed = written(full.select("_key", "_size"), "keys")
    total = keyed.agg(F.sum("_size")).first()[0] or 0
    each = max(1, min(MAX_PIECES // shards, math.ceil(total / shards / piece_bytes)))
    tight, loose = max(1, int(tolerance * total / shards)), total // (shards * each) // 4
    targets = [
        (total * i // (shards * each), loose if i % each else tight) for i in range(1, shards * each)
    ]
    bounds = find_splitters(keyed, total, targets) if total else []

    # How many rows lie below each piece, within its shard.
    rows = {r[0]: r[2] for r in count_below(keyed, bounds)}
    lookup, before = [], 0
    for piece in range(shards * each):
        before = 0 if piece % each == 0 else before
        lookup.append((piece, piece // each, before))
        before += rows.get(piece, 0)
    offsets = docs.sparkSession.createDataFrame(lookup, "_piece int, shard int, _before long")

    held = np.array(bounds, f"S{_DIGITS}")

    @F.pandas_udf("int")
    def piece_of(keys):
        import pandas as pd

        return pd.Series(np.searchsorted(held, keys.to_numpy().astype(f"S{_DIGITS}"), "right"))

    order = W.partitionBy("_piece").orderBy("_key", id_column)
    return (
        full.withColumn("_piece", piece_of("_key"))
        .withColumn("_rank", F.row_number().over(order))
        .join(F.broadcast(offsets), "_piece")
        .withColumn("slot", F.col("_before") + F.col("_rank") - 1)
        .select(*plain.columns, "shard", "slot")
        .withColumnsRenamed(back)
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder a shard, its files in the order of the slots."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
