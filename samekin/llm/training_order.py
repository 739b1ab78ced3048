"""Token ids in training order, as shards of records with a fixed stride.

Documents are tokenized and cut into sequences of at most ``LENGTH`` tokens. Sequences are numbered
0 to n - 1, and a keyed Feistel permutation of these numbers, walked along its cycle until it falls
below n, gives each its slot in the training order. No table of the order is ever made: the slot
follows from number and key. Shard and place in the shard follow from the slot, so any step can be
read, or training resumed from it, without an index.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samekin.llm.store import written
from samekin.llm.text import mixed, sliced
from samekin.llm.tokens import default_vocabulary, token_ids

LENGTH = 1024
END_ID = 50_256
KEY = 20_240_601
ROUNDS = 6
# Records of one shard, which one task holds at a time.
SHARD_SEQUENCES = 2_048
# A record: document, first token's place in it, number of tokens, then the ids, 0 where none is.
RECORD = np.dtype([("doc_id", "<i8"), ("start", "<i8"), ("length", "<i4"), ("spare", "<i4")])


def feistel(numbers: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """A permutation of 0 to n - 1 that depends on ``key``: a balanced Feistel network on the next
    even number of bits, repeated for results that are n or more."""
    half = max(1, (max(1, n - 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> shift, x & mask
        for i in range(ROUNDS):
            stirred = mixed(right + np.uint64((key * 0x9E3779B97F4A7C15 + i * 0xD1B54A32D192ED03) % (1 << 64)))
            left, right = right, left ^ (mixed(stirred) & mask)
        return left << shift | right

    result = once(numbers.astype(np.uint64))
    outside = np.flatnonzero(result >= np.uint64(n))
    while len(outside):
        result[outside] = once(result[outside])
        outside = outside[result[outside] >= np.uint64(n)]
    return result.astype(np.int64)


def sequences(
    docs: DataFrame, id_column: str, text_column: str, vocabulary: str, length: int
) -> DataFrame:
    """``doc_id``, ``start``, ``ids`` (unsigned 16-bit): each document and its end id, cut; and
    ``part``, ``row``: the partition they come from and their place in it."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        for batch in sliced(batches):
            rows: list[tuple] = []
            for doc_id, text in zip(batch["_id"].to_pylist(), batch["_text"].to_pylist()):
                ids = np.append(token_ids(text, vocabulary), np.uint32(END_ID)).astype("<u2")
                rows += [(doc_id, i, ids[i : i + length].tobytes()) for i in range(0, len(ids), length)]
                if len(rows) >= 512:
                    yield table(rows, done)
                    rows, done = [], done + len(rows)
            if rows:
                yield table(rows, done)
                done += len(rows)

    def table(rows: list[tuple], done: int) -> pa.RecordBatch:
        types = {"doc_id": pa.int64(), "start": pa.int64(), "ids": pa.binary()}
        columns = {n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(types.items())}
        columns["part"] = pa.array(np.full(len(rows), TaskContext.get().partitionId(), np.int32))
        columns["row"] = pa.array(np.arange(done, done + len(rows)))
        return pa.RecordBatch.from_pydict(columns)

    return docs.select(
        F.col(id_column).cast("long").alias("_id"), F.col(text_column).alias("_text")
    ).mapInArrow(cut, "doc_id long, start long, ids binary, part int, row long")


def training_shards(
    docs: DataFrame,
    key: int = KEY,
    length: int = LENGTH,
    shard_sequences: int = SHARD_SEQUENCES,
    id_column: str = "doc_id",
    text_column: str = "text",
    vocabulary: str | None = None,
) -> DataFrame:
    """``shard``, ``first_slot``, ``records``, ``stride`` and ``payload``: a row a shard, whose
    payload is its records in slot order, ``stride`` bytes each.

    Null and empty texts are one sequence, the end id alone. A row without an id is written with id
    -1. Repeated rows are documents of their own. No rows give no shards. Other columns are not read.

    Texts are tokenized once; the sequences are a table in the shared folder. They are numbered in
    the order in which the rows were read: each partition's count gives the next one's first number.
    The same files read in the same splits and the same key give the same order. Ids have to fit
    into 16 bits.
    """
    cut = written(
        sequences(docs, id_column, text_column, vocabulary or default_vocabulary(), length), "sequences"
    )
    # A row for each partition.
    lookup, total = [], 0
    for part, count in sorted(map(tuple, cut.groupBy("part").count().collect())):
        lookup.append((part, total))
        total += count
    offsets = docs.sparkSession.createDataFrame(lookup, "part int, _before long")
    stride = RECORD.itemsize + 2 * length

    @F.pandas_udf("long")
    def slot_of(numbers: pd.Series) -> pd.Series:
        return pd.Series(feistel(numbers.to_numpy(np.int64), total, key))

    numbered = (
        cut.join(F.broadcast(offsets), "part")
        .withColumn("slot", slot_of(F.col("_before") + F.col("row")))
        .select("doc_id", "start", "ids", "slot", F.floor(F.col("slot") / shard_sequences).alias("shard"))
    )

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("slot")
        payload = np.zeros((len(rows), stride), np.uint8)
        heads = np.zeros(len(rows), RECORD)
        heads["doc_id"] = rows["doc_id"].fillna(-1).astype(np.int64)
        heads["start"] = rows["start"]
        heads["length"] = [len(i) // 2 for i in rows["ids"]]
        payload[:, : RECORD.itemsize] = heads.view(np.uint8).reshape(len(rows), -1)
        for record, ids in zip(payload, rows["ids"]):
            record[RECORD.itemsize : RECORD.itemsize + len(ids)] = np.frombuffer(ids, np.uint8)
        shard = int(rows["shard"].iloc[0])
        return pd.DataFrame(
            {
                "shard": [shard],
                "first_slot": [shard * shard_sequences],
                "records": [len(rows)],
                "stride": [stride],
                "payload": [payload.tobytes()],
            }
        )

    return numbered.groupBy("shard").applyInPandas(
        pack, "shard long, first_slot long, records long, stride int, payload binary"
    )


def write_training_shards(shards: DataFrame, path: str) -> None:
    """Shards as Parquet, sorted and partitioned by ranges of shards."""
    shards.repartitionByRange("shard").sortWithinPartitions("shard").write.parquet(path)


def read_from(spark: SparkSession, path: str, slot: int) -> DataFrame:
    """The shards that hold ``slot`` and all later ones; earlier shards are pruned by the scan."""
    shards = spark.read.parquet(path)
    return shards.where(F.col("first_slot") + F.col("records") > slot).orderBy("shard")


def records(shards: DataFrame) -> DataFrame:
    """A row for each record: ``doc_id``, ``start``, ``length``, ``shard``, ``slot``, ``offset`` (bytes
    from the start of the shard) and ``ids_crc32`` of the ids, read back from the payload."""

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1):
            for row in batch.to_pylist():
                data = np.frombuffer(row["payload"], np.uint8).reshape(row["records"], row["stride"])
                heads = np.ascontiguousarray(data[:, : RECORD.itemsize]).view(RECORD).ravel()
                places = np.arange(row["records"])
                sums = [
                    zlib.crc32(d[RECORD.itemsize : RECORD.itemsize + 2 * n].tobytes())
                    for d, n in zip(data, heads["length"])
                ]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(heads["doc_id"]),
                        "start": pa.array(heads["start"]),
                        "length": pa.array(heads["length"].astype(np.int64)),
                        "shard": pa.array(np.full(len(places), row["shard"])),
                        "slot": pa.array(row["first_slot"] + places),
                        "offset": pa.array(places * row["stride"]),
                        "ids_crc32": pa.array(np.array(sums, np.int64)),
                    }
                )

    return shards.select("shard", "first_slot", "records", "stride", "payload").mapInArrow(
        parsed,
        "doc_id long, start long, length long, shard long, slot long, offset long, ids_crc32 long",
    )
