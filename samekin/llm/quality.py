"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages; only the bag has a label. Every passage is encoded, gated
attention (tanh and sigmoid branches, multiplied) gives it a weight among the document's passages,
and the weighted mean of the encodings is scored. A document with one bad passage can so be told
from one that is good throughout, though no passage was ever labelled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samekin.llm.text import encoded, in_batches, sliced

# At most about this many labelled documents of each class are used for fitting.
TRAIN_ROWS = 3_000
PASSAGE_BYTES = 400
# Hashed byte trigrams of a passage.
TRIGRAMS = 256
ENCODED = 24
ATTENTION = 12
EPOCHS = 14
BATCH_DOCS = 48
RATE = 0.004
L2 = 1e-4
# Labels are learnt only from ids whose checksum is not 0 by this number.
FOLDS = 5

# Byte classes counted in a passage: lower, upper, digits, blanks, line ends, and each of these.
_MARKS = b".,;:!?-'\"()/\\|#*$%&<>@_=+~[]{}"
_CLASSES = np.full(256, 5, np.int64)
_CLASSES[list(range(97, 123))] = 0
_CLASSES[list(range(65, 91))] = 1
_CLASSES[list(range(48, 58))] = 2
_CLASSES[[32, 9]] = 3
_CLASSES[[10, 13]] = 4
_CLASSES[list(_MARKS)] = 6 + np.arange(len(_MARKS))
CLASSES = 6 + len(_MARKS)
INPUTS = TRIGRAMS + CLASSES + 2


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of all texts, in order, and the number of passages of each text.
    Every byte belongs to one passage; an empty text is one empty passage."""
    sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    counts = np.maximum(1, -(-sizes // PASSAGE_BYTES))
    data = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64)
    firsts = np.concatenate(([0], np.cumsum(counts)))[:-1]
    begins = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    owner = np.repeat(firsts, sizes) + (np.arange(len(data)) - np.repeat(begins, sizes)) // PASSAGE_BYTES
    total = int(counts.sum())
    grams = np.zeros((total, TRIGRAMS), np.int64)
    if len(data) >= 3:
        codes = (data[:-2] * 65_599 + data[1:-1] * 257 + data[2:]) * 40_503 >> 7 & (TRIGRAMS - 1)
        whole = owner[:-2] == owner[2:]
        at = owner[:-2][whole] * TRIGRAMS + codes[whole]
        grams = np.bincount(at, minlength=total * TRIGRAMS).reshape(total, TRIGRAMS)
    kinds = np.bincount(owner * CLASSES + _CLASSES[data], minlength=total * CLASSES)
    kinds = kinds.reshape(total, CLASSES)
    used = np.bincount(owner, minlength=total)
    features = np.empty((total, INPUTS), np.float32)
    # Roots of shares: counts of any length become comparable, and rare ones do not vanish.
    features[:, :TRIGRAMS] = np.sqrt(grams / np.maximum(1, grams.sum(axis=1, keepdims=True)))
    features[:, TRIGRAMS:-2] = np.sqrt(kinds / np.maximum(1, used[:, None]))
    # How many different trigrams there are for the length, and the length.
    features[:, -2] = (grams > 0).sum(axis=1) / np.sqrt(1 + used)
    features[:, -1] = used / PASSAGE_BYTES
    return features, counts


@dataclass
class QualityModel:
    """``parameters`` by name; features are shifted and scaled before they are encoded."""

    shift: np.ndarray
    scale: np.ndarray
    parameters: dict[str, np.ndarray]

    def score(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return _forward(self.parameters, (features - self.shift) * self.scale, counts)[0]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def _forward(p: dict, x: np.ndarray, counts: np.ndarray) -> tuple:
    firsts = np.concatenate(([0], np.cumsum(counts)))[:-1]
    bag = np.repeat(np.arange(len(counts)), counts)
    code = np.maximum(0, x @ p["encode"] + p["encode_bias"])
    left, right = np.tanh(code @ p["left"]), _sigmoid(code @ p["right"])
    drawn = (left * right) @ p["attend"]
    weight = np.exp(drawn - np.maximum.reduceat(drawn, firsts)[bag])
    weight /= np.add.reduceat(weight, firsts)[bag]
    mean = np.add.reduceat(weight[:, None] * code, firsts, axis=0)
    score = _sigmoid(mean @ p["out"] + p["out_bias"][0])
    return score, code, left, right, weight, mean, bag, firsts


def _gradient(p: dict, x: np.ndarray, counts: np.ndarray, label, importance) -> dict:
    score, code, left, right, weight, mean, bag, firsts = _forward(p, x, counts)
    d_out = importance * (score - label) / importance.sum()
    d_mean = d_out[:, None] * p["out"][None, :]
    d_code = weight[:, None] * d_mean[bag]
    towards = (code * d_mean[bag]).sum(axis=1)
    d_drawn = weight * (towards - np.add.reduceat(weight * towards, firsts)[bag])
    d_left = d_drawn[:, None] * p["attend"] * right * (1 - left**2)
    d_right = d_drawn[:, None] * p["attend"] * left * right * (1 - right)
    d_code += d_left @ p["left"].T + d_right @ p["right"].T
    d_code *= code > 0
    found = {
        "out": mean.T @ d_out,
        "out_bias": np.array([d_out.sum()]),
        "attend": (left * right).T @ d_drawn,
        "left": code.T @ d_left,
        "right": code.T @ d_right,
        "encode": x.T @ d_code,
        "encode_bias": d_code.sum(axis=0),
    }
    return {k: v + L2 * p[k] for k, v in found.items()}


def fit_quality(
    features: np.ndarray, counts: np.ndarray, label: np.ndarray, importance: np.ndarray, seed: int = 7
) -> QualityModel:
    """Adam over shuffled batches of whole documents."""
    random = np.random.default_rng(seed)
    shift = features.mean(axis=0)
    scale = 1 / np.maximum(features.std(axis=0), 1e-3)
    x = (features - shift) * scale

    def drawn(*shape: int) -> np.ndarray:
        return (random.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    p = {
        "encode": drawn(x.shape[1], ENCODED),
        "encode_bias": np.zeros(ENCODED, np.float32),
        "left": drawn(ENCODED, ATTENTION),
        "right": drawn(ENCODED, ATTENTION),
        "attend": drawn(ATTENTION),
        "out": drawn(ENCODED),
        "out_bias": np.zeros(1, np.float32),
    }
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    begins = np.concatenate(([0], np.cumsum(counts)))
    step, steps = 0, EPOCHS * -(-len(counts) // BATCH_DOCS)
    for _ in range(EPOCHS):
        order = random.permutation(len(counts))
        for start in range(0, len(order), BATCH_DOCS):
            docs = order[start : start + BATCH_DOCS]
            rows = np.concatenate([np.arange(begins[d], begins[d + 1]) for d in docs])
            found = _gradient(p, x[rows], counts[docs], label[docs], importance[docs])
            step += 1
            rate = RATE * (1 - step / (steps + 1))
            for k, g in found.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                fast = first[k] / (1 - 0.9**step)
                p[k] = p[k] - rate * fast / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return QualityModel(shift, scale, p)


def held_out(doc_id: Column) -> Column:
    """Whether a document's label must not be learnt from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def train_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    rows: int = TRAIN_ROWS,
) -> QualityModel | None:
    """Fit on about ``rows`` labelled documents of each class that are not held out, chosen by a
    hash of the id and weighted back to the classes' shares. None if there are not both classes.
    Labels other than 0 and 1, and labels without a document, are not used."""
    known = labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col(id_column))).select(
        F.col(id_column).alias("_id"), (F.col("quality") == 1).alias("_good")
    )
    sizes = {r["_good"]: r["count"] for r in known.groupBy("_good").count().collect()}
    share = F.when(F.col("_good"), rows / max(1, sizes.get(True, 0))).otherwise(
        rows / max(1, sizes.get(False, 0))
    )
    place = F.pmod(F.xxhash64("_id", F.lit(5)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    few = known.where(place < share)

    def encoded_bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts, good = encoded(batch["_text"].to_pylist()), batch["_good"].to_pylist()
            for part in in_batches(texts, 1 << 19):
                features, counts = passages(texts[part])
                ends = np.cumsum(counts)
                yield pa.RecordBatch.from_pydict(
                    {
                        "_good": pa.array(good[part], pa.bool_()),
                        "_bag": pa.array(
                            [features[e - c : e].astype("<f2").tobytes() for c, e in zip(counts, ends)],
                            pa.binary(),
                        ),
                    }
                )

    sample = (
        docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
        .join(F.broadcast(few), "_id")
        .select("_text", "_good")
        .mapInArrow(encoded_bags, "_good boolean, _bag binary")
        .toArrow()
    )
    good = np.array(sample["_good"].to_pylist(), bool)
    if not good.any() or good.all():
        return None
    bags = [np.frombuffer(b, "<f2").reshape(-1, INPUTS) for b in sample["_bag"].to_pylist()]
    counts = np.array([len(b) for b in bags])
    share_of = {flag: sizes[flag] / (good == flag).sum() for flag in (True, False)}
    importance = np.where(good, share_of[True], share_of[False]).astype(np.float32)
    features = np.concatenate(bags).astype(np.float32)
    return fit_quality(features, counts, good.astype(np.float32), importance)


def quality(
    docs: DataFrame,
    model: QualityModel | None,
    id_column: str = "doc_id",
    text_column: str = "text",
    cut: float = 0.3,
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from ``cut`` on) for every
    row and its whole text. Null and empty texts are one empty passage. Without a model every
    score is 0.5. A row without an id counts as not held out. Other columns are not read."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = encoded(batch["_text"].to_pylist())
            for part in in_batches(texts, 1 << 19):
                score = np.full(len(texts[part]), 0.5)
                if model is not None:
                    score = model.score(*passages(texts[part])).astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [batch["_id"][part], batch["_held"][part], pa.array(score), pa.array((score >= cut).astype(np.int32))],
                    [id_column, "held_out", "score", "predicted"],
                )

    kind = docs.schema[id_column].dataType.simpleString()
    held = F.coalesce(held_out(F.col(id_column)), F.lit(False))
    return docs.select(
        F.col(id_column).alias("_id"), held.alias("_held"), F.col(text_column).alias("_text")
    ).mapInArrow(scored, f"`{id_column}` {kind}, held_out boolean, score double, predicted int")
