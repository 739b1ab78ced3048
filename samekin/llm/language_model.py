"""Log-probabilities of texts by deleted interpolation.

The probability of a token is a mixture of the maximum-likelihood estimates of all orders, from the
n-gram down to the single token, and of the uniform distribution. The weights depend on how often the
longest context that was seen at all was seen, in buckets of powers of two. They are learned on a part
of the training documents, the deleted part: n-grams are counted without it, and expectation-maximisation
finds the weights under which its tokens are likeliest. The final counts are those of all training
documents.

Counting and looking up are one shuffle each. Texts are turned into batches of word numbers once, and
written. A batch sends its distinct n-grams, as sorted hashes cut by ranges, with how often it has them;
whoever holds a range adds them up and sends each batch its totals back, in the order of its hashes, so
that these need not travel again. Nothing of the corpus is held by the driver or broadcast but the
mixture's weights, a row for each bucket.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samekin.llm.store import bucketed, written
from samekin.llm.text import encoded, mixed, sliced, word_hashes

# Fixed values of the contract: documents with this remainder are only scored.
MODULUS, SCORED_ONLY = 7, 2
# Training documents with this remainder are the deleted part.
DELETED = 3
ORDER = 2
# Bytes of text in a batch, and n-grams that one task adds up.
BATCH_BYTES = 6 << 20
GRAMS_TOGETHER = 2 << 20
# Expectation-maximisation ends when a token gains less than this, in natural logarithms.
GAIN = 1e-4
STEPS = 40
# A context's bucket is the power of two its count falls into, below this many.
POWERS = 64

KEPT, LEFT_OUT, UNSEEN = 0, 1, 2
_U = np.uint64
# Any two hashes that no word is likely to have.
END, BEFORE = mixed(np.array([0x0123456789ABCDEF, 0xFEDCBA9876543210], _U))
_MULTIPLIER = _U(0x9FB21C651E98DF25)


def packed(values: np.ndarray) -> bytes:
    """Unsigned 64-bit integers byte plane by byte plane, so that leading zeros compress."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zlib.compress(planes.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def _batches(docs: DataFrame, id_column: str, text_column: str, batch_bytes: int) -> DataFrame:
    """A row for each batch of whole documents: their ids, parts and numbers of tokens, the hashes of the
    distinct tokens, most frequent first, and the text as numbers into these."""
    key = F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")
    remainder = F.pmod(F.crc32(key), F.lit(MODULUS))
    part = F.when(remainder == SCORED_ONLY, UNSEEN).when(remainder == DELETED, LEFT_OUT).otherwise(KEPT)

    def one(ids: list, parts: list, texts: list[bytes], batch: int) -> pa.RecordBatch:
        words, offsets = word_hashes(texts)
        tokens = np.insert(words, offsets[1:], END)
        names, numbers, counts = np.unique(tokens, return_inverse=True, return_counts=True)
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return pa.RecordBatch.from_pydict(
            {
                "batch": pa.array([batch], pa.int64()),
                "ids": pa.array([ids], pa.list_(pa.int64())),
                "parts": pa.array([parts], pa.list_(pa.int32())),
                "lengths": pa.array([np.diff(offsets) + 1], pa.list_(pa.int64())),
                "names": pa.array([names[order].tobytes()], pa.binary()),
                "numbers": pa.array([packed(rank[numbers])], pa.binary()),
            }
        )

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, parts, texts, held = [], [], [], 0
        for batch in sliced(batches, 64):
            ids += batch["_id"].to_pylist()
            parts += batch["_part"].to_pylist()
            texts += encoded(batch["_text"].to_pylist())
            held = sum(map(len, texts)) + len(texts)
            if held >= batch_bytes:
                yield one(ids, parts, texts, number)
                number, ids, parts, texts, held = number + 1, [], [], [], 0
        if held:
            yield one(ids, parts, texts, number)

    return docs.select(
        F.col(id_column).cast("long").alias("_id"), part.alias("_part"), F.col(text_column).alias("_text")
    ).mapInArrow(
        made,
        "batch long, ids array<long>, parts array<int>, lengths array<long>, names binary, numbers binary",
    )


def _first(lengths: np.ndarray) -> np.ndarray:
    """Where each document begins."""
    return np.cumsum(lengths) - lengths


def _before(values: np.ndarray, lengths: np.ndarray, at_start) -> np.ndarray:
    """The value one token earlier; ``at_start`` for the first token of a document."""
    shifted = np.empty_like(values)
    shifted[1:] = values[:-1]
    shifted[_first(lengths)] = at_start
    return shifted


def grams(names: bytes, numbers: bytes, lengths: np.ndarray, order: int) -> np.ndarray:
    """The hash of the n-gram that ends at each token: a row for each n from 1 to ``order``. The lowest
    bit tells single tokens apart from the others."""
    tokens = np.frombuffer(names, _U)[unpacked(numbers)]
    history, found = [tokens], []
    for n in range(1, order + 1):
        name = np.full(len(tokens), n, _U)
        for token in reversed(history):
            name = mixed(name * _MULTIPLIER + token)
        found.append(name & ~_U(1) | _U(n == 1))
        history.append(_before(history[-1], lengths, BEFORE))
    return np.array(found)


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that sorts ``hashes``, and where runs of equal ones begin in it."""
    order = np.argsort(hashes)
    ordered = hashes[order]
    return order, np.flatnonzero(np.diff(ordered, prepend=~ordered[:1]))


def _answers(batches: DataFrame, order: int, ranges: int) -> DataFrame:
    """``batch``, ``target``, ``kept``, ``left_out`` and ``words``: for the n-grams that a batch has in a
    range of hashes, in their order, how often the two training parts have them; and how many distinct
    single tokens there are in that range (in the row of one batch only)."""
    width = 2**64 // ranges + 1

    def ask(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in sliced(rows, 1) for r in b.to_pylist()):
            lengths = np.array(row["lengths"], np.int64)
            parts = np.tile(np.repeat(np.array(row["parts"]), lengths), order)
            hashes = grams(row["names"], row["numbers"], lengths, order).ravel()
            sorting, first = _distinct(hashes)
            ordered = hashes[sorting][first]
            parts = parts[sorting]
            counts = [np.add.reduceat((parts == p).astype(np.uint64), first) for p in (KEPT, LEFT_OUT)]
            bounds = np.array([width * i for i in range(1, ranges)], _U)
            cuts = [0, *np.searchsorted(ordered, bounds), len(ordered)]
            for target, (begin, end) in enumerate(zip(cuts, cuts[1:])):
                if begin == end:
                    continue
                steps = np.diff(ordered[begin:end], prepend=_U(0))
                yield pa.RecordBatch.from_pydict(
                    {
                        "target": pa.array([target], pa.int32()),
                        "batch": pa.array([row["batch"]], pa.int64()),
                        "steps": pa.array([packed(steps)], pa.binary()),
                        "kept": pa.array([packed(counts[0][begin:end])], pa.binary()),
                        "left_out": pa.array([packed(counts[1][begin:end])], pa.binary()),
                    }
                )

    def add_up(rows: pa.Table) -> pa.Table:
        hashes = [np.cumsum(unpacked(s), dtype=_U) for s in rows["steps"].to_pylist()]
        ends = np.cumsum([len(h) for h in hashes])
        every = np.concatenate(hashes)
        sorting, first = _distinct(every)
        place = np.empty(len(every), np.int64)
        place[sorting] = np.repeat(np.arange(len(first)), np.diff(first, append=len(every)))
        totals = {}
        for name in ("kept", "left_out"):
            own = np.concatenate([unpacked(c) for c in rows[name].to_pylist()])
            totals[name] = np.add.reduceat(own[sorting], first)
        known = (every[sorting[first]] & _U(1) == 1) & (totals["kept"] + totals["left_out"] > 0)
        cuts = [slice(end - len(h), end) for h, end in zip(hashes, ends)]
        columns = {"batch": rows["batch"], "target": rows["target"]}
        columns |= {n: pa.array([packed(t[place[c]]) for c in cuts], pa.binary()) for n, t in totals.items()}
        words = np.zeros(len(rows), np.int64)
        words[0] = known.sum()
        return pa.Table.from_pydict(columns | {"words": pa.array(words)})

    asked = batches.select("batch", "parts", "lengths", "names", "numbers").mapInArrow(
        ask, "target int, batch long, steps binary, kept binary, left_out binary"
    )
    return asked.groupBy("target").applyInArrow(
        add_up, "batch long, target int, kept binary, left_out binary, words long"
    )


def _counted(batches: DataFrame, order: int, ranges: int) -> DataFrame:
    """A row for each batch: ``ids``, ``parts``, ``lengths``, ``words``, and for each token the counts of
    the n-grams that end there, all orders one after the other: ``counts`` in all training documents,
    ``kept`` without the deleted part, for the tokens of that part only."""

    def placed(rows: pa.Table, answers: pa.Table) -> pa.Table:
        row, answers = rows.to_pylist()[0], answers.sort_by("target")
        lengths = np.array(row["lengths"], np.int64)
        hashes = grams(row["names"], row["numbers"], lengths, order).ravel()
        sorting, first = _distinct(hashes)
        place = np.empty(len(hashes), np.int64)
        place[sorting] = np.repeat(np.arange(len(first)), np.diff(first, append=len(hashes)))
        kept, left_out = (
            np.concatenate([unpacked(a) for a in answers[name].to_pylist()])[place]
            for name in ("kept", "left_out")
        )
        deleted = np.tile(np.repeat(np.array(row["parts"]) == LEFT_OUT, lengths), order)
        return rows.select(["ids", "parts", "lengths"]).append_column(
            "words", pa.array([sum(answers["words"].to_pylist())], pa.int64())
        ).append_column("counts", pa.array([packed(kept + left_out)], pa.binary())).append_column(
            "kept", pa.array([packed(kept[deleted])], pa.binary())
        )

    answers = _answers(batches, order, ranges)
    return (
        batches.groupBy("batch")
        .cogroup(answers.groupBy("batch"))
        .applyInArrow(
            placed,
            "ids array<long>, parts array<int>, lengths array<long>, words long, counts binary, kept binary",
        )
    )


def contexts(counts: np.ndarray, lengths: np.ndarray, documents: int) -> np.ndarray:
    """How often the context of each n-gram occurs, for n of 2 and more. What is before a document
    occurs once in each of ``documents``."""
    found = [_before(row, lengths, documents) for row in counts[:-1]]
    return np.array(found, np.int64).reshape(len(found), counts.shape[1])


def buckets(seen: np.ndarray) -> np.ndarray:
    """The longest context with any occurrence, and the power of two of these."""
    bucket = np.zeros(seen.shape[1], np.int64)
    for n, row in enumerate(seen, 1):
        power = np.frexp(row.astype(np.float64))[1] - 1
        bucket = np.where(row > 0, n * POWERS + power, bucket)
    return bucket


def _estimates(counts: np.ndarray, seen: np.ndarray, tokens: int, words: int) -> np.ndarray:
    """The uniform probability, and the maximum-likelihood estimate of each order (0 without context)."""
    below = np.vstack([np.full((1, counts.shape[1]), max(1, tokens)), np.maximum(seen, 1)])
    uniform = np.full((1, counts.shape[1]), 1.0 / (words + 1))
    return np.vstack([uniform, counts / below])


def _held_out(counted: DataFrame, order: int, documents: int) -> DataFrame:
    """``bucket``, the counts ``c1`` to ``cn`` without the deleted part and ``x2`` to ``xn`` of the
    contexts, and how many tokens of the deleted part have them (``times``)."""
    names = [f"c{n}" for n in range(1, order + 1)] + [f"x{n}" for n in range(2, order + 1)]

    def told(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in sliced(rows, 1) for r in b.to_pylist()):
            lengths = np.array(row["lengths"], np.int64)[np.array(row["parts"]) == LEFT_OUT]
            counts = unpacked(row["kept"]).reshape(order, -1).astype(np.int64)
            if not counts.size:
                continue
            seen = contexts(counts, lengths, documents)
            table = np.vstack([buckets(seen)[None, :], counts, seen])
            sorting = np.lexsort(table)
            table = table[:, sorting]
            first = np.flatnonzero(np.r_[True, (np.diff(table, axis=1) != 0).any(axis=0)])
            times = np.diff(first, append=table.shape[1])
            columns = {n: pa.array(v) for n, v in zip(["bucket", *names], table[:, first])}
            yield pa.RecordBatch.from_pydict(columns | {"times": pa.array(times)})

    schema = ", ".join(f"{n} long" for n in ["bucket", *names, "times"])
    return (
        counted.select("parts", "lengths", "kept")
        .mapInArrow(told, schema)
        .groupBy("bucket", *names)
        .agg(F.sum("times").alias("times"))
    )


def _start(order: int) -> np.ndarray:
    """Equal weights of the orders a bucket has a context for."""
    weights = np.zeros((order * POWERS, order + 1))
    for n in range(order):
        weights[n * POWERS : (n + 1) * POWERS, : n + 2] = 1.0 / (n + 2)
    return weights


def fit_weights(held_out: DataFrame, order: int, tokens: int, words: int) -> np.ndarray:
    """Mixture weights, a row for each bucket, by expectation-maximisation on the ``held_out`` counts.
    A bucket without any keeps the weights of the next lower one that has the same context length."""

    def estimate(n: int) -> Column:
        if n == 0:
            return F.lit(1.0 / (words + 1))
        below = F.lit(max(1, tokens)) if n == 1 else F.greatest(F.col(f"x{n}"), F.lit(1))
        return F.col(f"c{n}") / below

    table = written(
        held_out.select("bucket", "times", *[estimate(n).alias(f"p{n}") for n in range(order + 1)]), "held_out"
    )
    weights, last = _start(order), -math.inf
    for _ in range(STEPS):
        shares = [
            F.element_at(F.lit(weights[:, n].tolist()), (F.col("bucket") + 1).cast("int")) * F.col(f"p{n}")
            for n in range(order + 1)
        ]
        told = table.select("bucket", "times", *[s.alias(f"s{n}") for n, s in enumerate(shares)])
        total = sum((F.col(f"s{n}") for n in range(1, order + 1)), F.col("s0"))
        seen = (
            told.withColumn("total", total)
            .groupBy("bucket")
            .agg(
                F.sum("times").alias("times"),
                F.sum(F.col("times") * F.ln("total")).alias("likelihood"),
                *[F.sum(F.col("times") * F.col(f"s{n}") / F.col("total")).alias(f"s{n}") for n in range(order + 1)],
            )
            .collect()
        )
        count = sum(r["times"] for r in seen)
        likelihood = math.fsum(r["likelihood"] for r in seen)
        for r in seen:
            # One token more for each order the bucket has, so that no weight becomes 0.
            had = r["bucket"] // POWERS + 2
            for n in range(had):
                weights[r["bucket"], n] = (r[f"s{n}"] + 1.0) / (r["times"] + had)
        if not count or likelihood - last < GAIN * count:
            break
        last = likelihood
    known = {r["bucket"] for r in seen}
    for bucket in range(len(weights)):
        if bucket not in known and bucket % POWERS and bucket - 1 in known:
            weights[bucket] = weights[bucket - 1]
            known.add(bucket)
    return weights


def _scored(
    counted: DataFrame,
    id_column: str,
    order: int,
    tokens: int,
    words: int,
    documents: int,
    weights: np.ndarray,
) -> DataFrame:
    def scored(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in sliced(rows, 1) for r in b.to_pylist()):
            lengths = np.array(row["lengths"], np.int64)
            counts = unpacked(row["counts"]).reshape(order, -1).astype(np.int64)
            seen = contexts(counts, lengths, documents)
            total = np.zeros(counts.shape[1])
            bucket = buckets(seen)
            for n, estimate in enumerate(_estimates(counts, seen, tokens, words)):
                total += weights[bucket, n] * estimate
            first = _first(lengths)
            base = np.log10((counts[0] + 1) / (tokens + words + 1))
            held_out = np.array(row["parts"]) == UNSEEN
            yield pa.RecordBatch.from_pydict(
                {
                    id_column: pa.array(row["ids"], pa.int64()),
                    "held_out": pa.array(held_out),
                    "n_tokens": pa.array(lengths),
                    "n_known": pa.array(np.add.reduceat((counts[0] > 0).astype(np.int64), first)),
                    "train_tokens": pa.array(np.full(len(lengths), tokens)),
                    "base_score": pa.array(np.add.reduceat(base, first)),
                    "score": pa.array(np.add.reduceat(np.log10(total), first)),
                }
            )

    return counted.select("ids", "parts", "lengths", "counts").mapInArrow(
        scored,
        f"`{id_column}` long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double",
    )


def language_model_scores(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    order: int = ORDER,
    batch_bytes: int = BATCH_BYTES,
    grams_together: int = GRAMS_TOGETHER,
) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``
    for every row: base-10 logarithms of the probability of its whole text, by single tokens with one
    added to each count, and by the interpolated model of n-grams up to ``order``.

    Tokens are the words between white space, A-Z lower-cased, and an end after each text. Rows whose
    CRC-32 of the id modulo ``MODULUS`` is ``SCORED_ONLY`` are held out: nothing is learned from them.
    Those with remainder ``DELETED`` are training documents that the weights are learned on.

    Null and empty texts are the end alone. A row without an id has the CRC-32 of no bytes, 0. Repeated
    rows are documents of their own. No rows give no rows; other columns are not read. Without training
    documents only the uniform distribution is left; without a deleted part the weights stay equal.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    batches = bucketed(
        _batches(docs, id_column, text_column, batch_bytes), "batches", "batch", partitions
    )
    part, length = F.col("document.parts"), F.col("document.lengths")
    each = batches.select(F.explode(F.arrays_zip("parts", "lengths")).alias("document"))
    summed = each.groupBy(part.alias("part")).agg(
        F.count("*").alias("documents"), F.sum(length).alias("tokens")
    )
    sums = {r["part"]: r for r in summed.collect()}

    def over(name: str, *parts: int) -> int:
        return sum(sums[p][name] for p in parts if p in sums)

    ranges = max(partitions, math.ceil(order * over("tokens", KEPT, LEFT_OUT, UNSEEN) / grams_together))
    counted = written(_counted(batches, order, ranges), "counted")
    words = counted.agg(F.sum("words")).first()[0] or 0
    held_out = _held_out(counted, order, over("documents", KEPT))
    weights = fit_weights(held_out, order, over("tokens", KEPT), words)
    if not over("tokens", KEPT, LEFT_OUT):
        weights[:, 0], weights[:, 1:] = 1.0, 0.0
    return _scored(
        counted,
        id_column,
        order,
        over("tokens", KEPT, LEFT_OUT),
        words,
        over("documents", KEPT, LEFT_OUT),
        weights,
    )
