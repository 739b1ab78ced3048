"""Alignment of two tokenizers over the same bytes.

Both tokenize a text behind one space: byte-level BPE (A) and BPE of pieces with byte fallback (B). A
token is the range of bytes it stands for. In a batch of documents the tokens of either side are a table
of document and first byte, and an as-of merge, keyed by document, finds for each token the other side's
token that covers its first byte. Of two tokens that overlap the later one starts inside the other, so
the union of both directions is all overlaps; where both start together they are found twice and kept
once. Overlapping tokens that end together close a group.

How often two ids overlap in the whole corpus takes a second look. A batch sends each id pair once, with
its number of links; the totals come back to the batch, where every document kept its pairs as numbers
into the batch's list.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from samekin.llm.store import written
from samekin.llm.text import sliced
from samekin.llm.tokens import byte_level, default_pieces, default_vocabulary, pieces

# Bytes of text aligned together.
BATCH_BYTES = 1 << 20
# Characters of words whose tokens a worker remembers.
REMEMBERED = 16 << 20
# White space before a space: such texts are cut less often.
_SPACED = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= )")


def words_of(text: str) -> list[str]:
    """Parts of ``text`` that both sides tokenize on their own: space + text is the parts, each behind a
    space. Cuts are before the first space behind something else than white space. Neither side has a
    token that reaches across: in A a space begins a piece there, in B none has a space behind others."""
    if not text.startswith(" ") and not _SPACED.search(text):
        return text.split(" ")
    return [part[1:] for part in _CUT.split(" " + text)]


class _Side:
    """What a worker remembers of one tokenizer: the ids of words, one word after the other."""

    def __init__(self) -> None:
        self.begins, self.words = np.zeros(1 << 10, np.int64), 0
        self.ids = np.zeros(1 << 12, np.int32)

    def add(self, words: list[list[int]]) -> None:
        ends = self.begins[self.words] + np.cumsum([len(w) for w in words])
        while self.words + len(words) >= len(self.begins):
            self.begins = np.append(self.begins, np.zeros_like(self.begins))
        while ends[-1] > len(self.ids):
            self.ids = np.append(self.ids, np.zeros_like(self.ids))
        self.ids[self.begins[self.words] : ends[-1]] = np.fromiter(chain.from_iterable(words), np.int32)
        self.begins[self.words + 1 : self.words + 1 + len(words)] = ends
        self.words += len(words)


class _Memory:
    """Tokens of the words that a worker has seen, numbered as they came."""

    def __init__(self, vocabulary: str, model: str) -> None:
        self.encoding, self.model = byte_level(vocabulary), pieces(model)
        self.names = [self.encoding.token_bytes, self.model.token_bytes]
        self.sizes = [np.array([len(n) for n in names], np.int64) for names in self.names]
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.held = 0
        self.sides = [_Side(), _Side()]
        self.whole: list[bool] = []

    def numbers(self, words: list[str]) -> list[int]:
        fresh = [w for w in dict.fromkeys(words) if w not in self.known]
        if fresh:
            told = [self.encoding.encode_behind_space(fresh), self.model.encode_behind_space(fresh)]
            for side, ids in zip(self.sides, told):
                side.add(ids)
            for word, *both in zip(fresh, *told):
                data = (" " + word).encode()
                spelt = [b"".join([n[i] for i in ids]) for n, ids in zip(self.names, both)]
                self.whole.append(spelt == [data, data])
                self.known[word] = len(self.known)
                self.held += len(word) + 1
        return [self.known[w] for w in words]


_memories: dict[tuple[str, str], _Memory] = {}


def _memory(vocabulary: str, model: str) -> _Memory:
    """That of this worker; emptied when it holds too much."""
    key = vocabulary, model
    if key not in _memories:
        _memories[key] = _Memory(vocabulary, model)
    elif _memories[key].held > REMEMBERED:
        _memories[key].forget()
    return _memories[key]


@dataclass
class Tokens:
    """One side of a batch: for each token its document (its place in the batch), id, and bytes from
    ``start`` to ``end``, counted through the batch."""

    doc: np.ndarray
    id: np.ndarray
    start: np.ndarray
    end: np.ndarray


def tokens_of(texts: list[str | None], vocabulary: str, model: str) -> list[Tokens]:
    """Both sides of a batch. Texts that are null or empty, or whose bytes a side does not give back,
    have no tokens."""
    memory = _memory(vocabulary, model)
    parts = [words_of(t) if t else [] for t in texts]
    numbers = np.array(memory.numbers([w for p in parts for w in p]), np.int64)
    docs = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
    lost = np.unique(docs[~np.array(memory.whole, bool)[numbers]]) if len(numbers) else docs
    if len(lost):
        keep = ~np.isin(docs, lost)
        numbers, docs = numbers[keep], docs[keep]
    found = []
    for side, sizes in zip(memory.sides, memory.sizes):
        begins = side.begins
        counts = begins[numbers + 1] - begins[numbers]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(begins[numbers] - (ends - counts), counts)
        own = side.ids[at].astype(np.int64)
        stop = np.cumsum(sizes[own])
        found.append(Tokens(np.repeat(docs, counts), own, stop - sizes[own], stop))
    return found


def links(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of places in ``a`` and ``b`` of tokens that overlap, each once."""

    def table(side: Tokens, name: str) -> pd.DataFrame:
        return pd.DataFrame({"doc": side.doc, "at": side.start, name: np.arange(len(side.doc))})

    if not len(a.doc):
        return a.doc, b.doc
    left, right = table(a, "a"), table(b, "b")
    # Documents follow each other, so first bytes ascend through the batch.
    from_a = pd.merge_asof(left, right, on="at", by="doc")["b"].to_numpy()
    from_b = pd.merge_asof(right, left, on="at", by="doc")["a"].to_numpy()
    later = np.flatnonzero(a.start[from_b] != b.start)
    return np.concatenate([left["a"], from_b[later]]), np.concatenate([from_a, later])


def _closing(side: Tokens, other: Tokens) -> np.ndarray:
    """Whether a token of the other side ends where this one does."""
    # Both sides of a document end together, so nothing lies behind the last end.
    return other.end[np.searchsorted(other.end, side.end)] == side.end


def _digits(count: int) -> np.ndarray:
    """The decimal digits of 0 to ``count`` - 1 as bytes, each padded by zero bytes."""
    names = np.array([str(i) for i in range(count)], "S")
    return names.view(np.uint8).reshape(count, -1)


def group_texts(a: Tokens, b: Tokens, docs: int, digits: list[np.ndarray]) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` for each document: the ids of each group in order."""
    keys, closes = [], []
    for side, other in ((a, b), (b, a)):
        closing = _closing(side, other)
        # Groups are numbered through the batch; A's ids come before B's.
        keys.append(2 * (np.cumsum(closing) - closing) + len(keys))
        closes.append(closing)
    # Where each token goes: behind its own side's and the other side's earlier ones.
    place = [
        np.arange(len(k)) + np.searchsorted(other, k) for k, other in ((keys[0], keys[1]), (keys[1], keys[0]))
    ]
    width = max(d.shape[1] for d in digits)
    total = len(a.id) + len(b.id)
    rows = np.zeros((total, width + 1), np.uint8)
    doc = np.zeros(total, np.int64)
    for side, spot, closing, table, mark in zip((a, b), place, closes, digits, b"|;"):
        rows[spot, : table.shape[1]] = table[side.id]
        rows[spot, width] = np.where(closing, mark, ord(","))
        doc[spot] = side.doc
    flat = rows.ravel()
    data = flat[flat != 0].tobytes()
    sizes = np.bincount(doc, (rows != 0).sum(axis=1), docs).astype(np.int64)
    ends = np.cumsum(sizes)
    # Without the mark behind the last group.
    return [data[end - size : max(end - 1, end - size)] for end, size in zip(ends.tolist(), sizes.tolist())]


_SCHEMA = (
    "batch long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, numbers binary, "
    "times binary, a array<int>, b array<int>, n array<long>"
)


def _aligned(
    docs: DataFrame, id_column: str, text_column: str, vocabulary: str, model: str, batch_bytes: int
) -> DataFrame:
    """A row for each document, with its id pairs as numbers into the list of the batch, and how many
    links each has. The first row of a batch also has that list (``a``, ``b``, ``n``)."""
    kind = docs.schema[id_column].dataType.simpleString()

    def one(
        ids: list[pa.Array], texts: list[str | None], batch: int, digits: list[np.ndarray]
    ) -> pa.RecordBatch:
        a, b = tokens_of(texts, vocabulary, model)
        i, j = links(a, b)
        pairs = a.id[i] << 32 | b.id[j]
        names, number = np.unique(pairs, return_inverse=True)
        totals = np.bincount(number, minlength=len(names))
        # Frequent pairs get small numbers.
        order = np.argsort(-totals, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        names, totals = names[order], totals[order]
        own = np.sort(a.doc[i] * max(1, len(names)) + rank[number])
        first = np.flatnonzero(np.diff(own, prepend=-1))
        times, own = np.diff(first, append=len(own)), own[first]
        doc, own = own // max(1, len(names)), own % max(1, len(names))
        size = len(texts)
        cuts = np.searchsorted(doc, np.arange(size + 1))

        def count(values: np.ndarray) -> pa.Array:
            return pa.array(np.bincount(values, minlength=size), pa.int64())

        def planes(values: np.ndarray) -> bytes:
            return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()

        def listed(values: np.ndarray, kind: pa.DataType) -> pa.Array:
            return pa.array([values] + [None] * (size - 1), pa.list_(kind))

        texts_of = group_texts(a, b, size, digits)
        spans = [slice(x, y) for x, y in zip(cuts, cuts[1:])]
        return pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays(ids),
                pa.array(np.full(size, batch)),
                count(a.doc),
                count(b.doc),
                count(a.doc[_closing(a, b)]),
                count(a.doc[i]),
                pa.array([hashlib.sha256(t).hexdigest() if t else "" for t in texts_of], pa.string()),
                pa.array([planes(np.diff(own[s], prepend=0)) for s in spans], pa.binary()),
                pa.array([planes(times[s]) for s in spans], pa.binary()),
                listed(names >> 32, pa.int32()),
                listed(names & 0xFFFFFFFF, pa.int32()),
                listed(totals, pa.int64()),
            ],
            ["_id", "batch", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "numbers", "times", "a", "b", "n"],
        )

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        digits = [_digits(len(names)) for names in _memory(vocabulary, model).names]
        ids: list[pa.Array] = []
        texts: list[str | None] = []
        held = 0
        for batch in sliced(batches, 32):
            ids.append(batch["_id"])
            texts += batch["_text"].to_pylist()
            held += batch["_text"].nbytes
            if held >= batch_bytes:
                yield one(ids, texts, number, digits)
                number, ids, texts, held = number + 1, [], [], 0
        if texts:
            yield one(ids, texts, number, digits)

    return docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")).mapInArrow(
        made, f"_id {kind}, {_SCHEMA}"
    )


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``a``, ``b``, ``n`` and ``best`` for every id pair of the corpus: its links, and whether no other
    pair has more for the same ``b``. A ``b`` has at most as many pairs as A has ids."""
    every = aligned.where(F.col("a").isNotNull()).select(F.explode(F.arrays_zip("a", "b", "n")).alias("pair"))
    summed = every.select("pair.*").groupBy("a", "b").agg(F.sum("n").alias("n"))
    return summed.withColumn("best", F.col("n") == F.max("n").over(W.partitionBy("b")))


def aligned_tokens(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    vocabulary: str | None = None,
    model: str | None = None,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """A row for each document: ``doc_id``, ``n_a``, ``n_b`` (tokens), ``n_groups`` (stretches between
    bytes where tokens of both sides end), ``n_links`` (overlapping A-B pairs), ``n_best`` (links whose
    id pair has the most links of all pairs of its B id in the corpus, ties included), ``count_sum``
    (of the corpus's number of links of each link's id pair) and ``groups_sha256`` (of ``group_texts``).

    Special tokens inside texts are plain text. Null and empty texts, and those whose bytes one side does
    not give back, have no tokens: zeros and an empty string. Repeated rows are documents of their own,
    and count in the corpus as often as they are. No rows give no rows; other columns are not read. Texts
    are whole; a batch holds whole documents, so a very long one is a batch by itself.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    aligned = written(
        _aligned(
            docs,
            id_column,
            text_column,
            vocabulary or default_vocabulary(),
            model or default_pieces(),
            batch_bytes,
        ),
        "aligned",
    )
    counts = written(pair_counts(aligned), "pair_counts")
    listed = aligned.where(F.col("a").isNotNull()).select(
        "batch", F.posexplode(F.arrays_zip("a", "b")).alias("place", "pair")
    )
    known = listed.select("batch", "place", "pair.a", "pair.b").join(counts, ["a", "b"]).select(
        "batch", "place", "n", "best"
    )

    def read(data: bytes) -> np.ndarray:
        return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()

    def looked_up(rows: pa.Table, answers: pa.Table) -> pa.Table:
        order = np.argsort(answers["place"].to_numpy())
        n = answers["n"].to_numpy()[order]
        best = answers["best"].to_numpy().astype(np.int64)[order]
        sums: list[list[int]] = [[], []]
        for data, own in zip(rows["numbers"].to_pylist(), rows["times"].to_pylist()):
            place, times = np.cumsum(read(data), dtype=np.int64), read(own).astype(np.int64)
            for values, total in zip((best, n), sums):
                total.append(int((values[place] * times).sum()) if len(place) else 0)
        kept = rows.drop_columns(["batch", "numbers", "times"])
        for name, total in zip(("n_best", "count_sum"), sums):
            kept = kept.append_column(name, pa.array(total, pa.int64()))
        return kept

    # A name of its own, since both sides come from the same table.
    rows = aligned.drop("a", "b", "n").withColumn("batch", F.col("batch") + 0)
    looked = rows.groupBy("batch").cogroup(known.groupBy("batch")).applyInArrow(
        looked_up,
        f"_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "n_best long, count_sum long",
    )
    return looked.select(
        F.col("_id").alias(id_column),
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        "n_best",
        "count_sum",
        "groups_sha256",
    )
