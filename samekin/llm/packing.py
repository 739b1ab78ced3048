"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are powers of two: as many of the longest
length as fit, then the binary digits of the rest, largest first. Every piece is a sequence of its
own, so no sequence crosses documents and none is padded. Sequences of equal length are numbered
one after the other: a batch drawn from a bucket has no ragged rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from samekin.llm.store import written
from samekin.llm.text import sliced
from samekin.llm.tokens import default_vocabulary, token_ids
from samekin.operators.skew import sized_join

LONGEST = 2048
# Put after each document.
END_ID = 1
# Token bytes held by a task before they go out.
FLUSH_BYTES = 4 << 20


def binary_lengths(tokens: int, longest: int = LONGEST) -> Iterator[int]:
    """The pieces of a document of so many tokens; ``longest`` is a power of two."""
    yield from [longest] * (tokens // longest)
    rest = tokens % longest
    for bit in reversed(range(rest.bit_length())):
        if rest >> bit & 1:
            yield 1 << bit


def pieces(
    docs: DataFrame,
    id_column: str,
    text_column: str,
    vocabulary: str,
    longest: int,
    end_id: int,
) -> DataFrame:
    """``doc_id``, ``start``, ``length``, ``doc_tokens``, ``ids`` (little-endian unsigned 32-bit)
    and their checksum, a row a piece; and ``part``, ``rank``: the partition it comes from and how many
    of its length came before it there."""
    kind = docs.schema[id_column].dataType.simpleString()
    names = [id_column, "start", "length", "doc_tokens", "ids_crc32", "ids", "part", "rank"]

    def flushed(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        types = [id_type, *[pa.int64()] * 4, pa.binary(), pa.int32(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names
        )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), Counter()
        for batch in sliced(batches):
            rows, held = [], 0
            for doc_id, text in zip(batch["_id"].to_pylist(), batch["_text"].to_pylist()):
                data = np.append(token_ids(text, vocabulary), np.uint32(end_id)).astype("<u4").tobytes()
                start, total = 0, len(data) // 4
                for length in binary_lengths(total, longest):
                    ids = data[4 * start : 4 * (start + length)]
                    rows.append((doc_id, start, length, total, zlib.crc32(ids), ids, part, seen[length]))
                    seen[length] += 1
                    start += length
                held += len(data)
                if held >= FLUSH_BYTES:
                    yield flushed(rows, batch["_id"].type)
                    rows, held = [], 0
            if rows:
                yield flushed(rows, batch["_id"].type)

    schema = (
        f"`{id_column}` {kind}, start long, length long, doc_tokens long, ids_crc32 long, ids binary, "
        "part int, rank long"
    )
    return docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")).mapInArrow(
        cut, schema
    )


def pack_binary(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    vocabulary: str | None = None,
    longest: int = LONGEST,
    end_id: int = END_ID,
) -> DataFrame:
    """``doc_id``, ``start``, ``length``, ``doc_tokens``, ``ids``, ``ids_crc32``, ``sequence_id``,
    ``offset`` (always 0): the pieces of every row's whole text, a sequence each.

    Sequence ids are gapless from 0, shorter lengths first. Null and empty texts are one piece,
    the end id alone. Repeated rows are documents of their own; no rows give no sequences; other
    columns are not read.

    Texts are tokenized once; the pieces are a table in the shared folder. They are numbered in the order
    in which they were made: what each partition has of a length gives the next one's first number, so
    pieces are not moved. Those counts are broadcast only if they are measured to be few.
    """
    cut = written(
        pieces(docs, id_column, text_column, vocabulary or default_vocabulary(), longest, end_id),
        "pieces",
    )
    made = cut.groupBy("length", "part").agg(F.count("*").alias("_rows"))
    # At most one row for each power of two.
    counts = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}
    shorter, before = F.lit(0), 0
    for length in sorted(counts):
        shorter = F.when(F.col("length") == length, before).otherwise(shorter)
        before += counts[length]
    earlier = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    rows = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    offsets = made.select("length", "part", (shorter + rows).alias("_before"))
    return sized_join(cut, offsets, ["length", "part"], "inner").select(
        id_column,
        "start",
        "length",
        "doc_tokens",
        "ids",
        "ids_crc32",
        (F.col("_before") + F.col("rank")).cast("long").alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
