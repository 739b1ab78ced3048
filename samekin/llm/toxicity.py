"""Toxicity by cumulative-link ordinal regression on sparse text features.

A document has a hashed feature for each word (letters only, lower case) and for each of its stems.
One weight vector serves all severity grades; ascending cut points part them:
P(grade >= k) = sigmoid(w x - c_k). The expected severity is the sum of these over k.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samekin.llm.text import NO_LETTERS, encoded, in_batches, sliced, word_hashes

# At most about this many labelled documents of each class are used for fitting.
TRAIN_ROWS = 4_000
FEATURE_BITS = 22
# Leading bytes of a word that make a feature of their own.
STEMS = (4, 5, 6)
# Features used by the regression: those most tied to the label, by at least this score, which is
# about that of a standard normal variable.
FEATURES = 512
LEAST_Z = 6.0
GRADES = 3
# Documents whose probability of grade 1 or more is at least this are toxic.
CUT = 0.3
STEPS = 400
L2 = 3e-5


def features(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The distinct feature numbers of each text."""
    hashes, offsets = word_hashes(texts, NO_LETTERS, stems=STEMS)
    numbers = (hashes >> np.uint64(64 - FEATURE_BITS)).astype(np.uint32)
    for begin, end in zip(offsets, offsets[1:]):
        own = np.unique(numbers[:, begin:end])
        # 0 stands for a word too short for a stem.
        yield own[1:] if len(own) and own[0] == 0 else own


@dataclass(frozen=True)
class SeverityModel:
    """``numbers``: the features used, ascending; ``cuts``: one for each grade above 0."""

    numbers: np.ndarray
    weights: np.ndarray
    cuts: np.ndarray

    def at_least(self, found: list[np.ndarray]) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ...: a row for each document."""
        scores = np.zeros(len(found))
        for i, own in enumerate(found):
            at = np.searchsorted(self.numbers, own)
            hit = at < len(self.numbers)
            hit[hit] = self.numbers[at[hit]] == own[hit]
            scores[i] = self.weights[at[hit]].sum()
        return _sigmoid(scores[:, None] - self.cuts[None, :])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def _chosen(found: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """The features tied to the label. Counted in place a document at a time: together the documents'
    features, sorted and with a float each, would be the most that the driver ever holds."""
    counts = np.zeros((2, 1 << FEATURE_BITS), np.uint32)
    for own, flag in zip(found, toxic):
        counts[int(flag), own] += 1
    names = np.flatnonzero(counts.any(axis=0)).astype(np.uint32)
    without, with_label = counts[:, names].astype(np.float64)
    both = with_label + without
    n1, n0 = toxic.sum(), (~toxic).sum()
    # Signed root of the likelihood ratio of one rate for both classes against one for each.
    z = np.zeros(len(names))
    for has, size in ((with_label, n1), (without, n0)):
        for seen, all_seen in ((has, both), (size - has, len(toxic) - both)):
            expected = all_seen * size / len(toxic)
            z += 2 * seen * np.log(np.maximum(seen, 1e-12) / np.maximum(expected, 1e-12))
    z = np.sqrt(np.maximum(z, 0)) * np.sign(with_label * n0 - without * n1)
    order = np.lexsort((names, -z))[:FEATURES]
    return np.sort(names[order[z[order] >= LEAST_Z]])


def _grades(counts: np.ndarray, toxic: np.ndarray, grades: int) -> np.ndarray:
    """The labels only tell toxic from not. A toxic document's grade is its place among the toxic
    ones by the number of tied features it has, in ``grades`` equal parts."""
    edges = np.quantile(counts[toxic], np.arange(1, grades) / grades) if toxic.any() else []
    return np.where(toxic, 1 + np.searchsorted(edges, counts, "left"), 0)


def fit_severity(
    found: list[np.ndarray], toxic: np.ndarray, weight: np.ndarray, grades: int = GRADES
) -> SeverityModel:
    """Fit weights and cut points together, by gradient steps (Adam) on the ordinal likelihood.
    The gaps between cut points are exponentials, so they stay in order."""
    numbers = _chosen(found, toxic)
    x = np.zeros((len(found), len(numbers)))
    for i, own in enumerate(found):
        x[i] = np.isin(numbers, own, assume_unique=True)
    grade = _grades(x.sum(axis=1), toxic, grades)
    # Cumulative: column k says whether the grade is above k.
    above = (grade[:, None] > np.arange(grades)[None, :]).astype(float)
    total = weight.sum()
    parameters = np.concatenate([np.zeros(len(numbers)), [2.0], np.zeros(grades - 1)])
    first, second = np.zeros_like(parameters), np.zeros_like(parameters)
    for step in range(1, STEPS + 1):
        w, cut, gaps = np.split(parameters, [len(numbers), len(numbers) + 1])
        cuts = np.concatenate([cut, cut + np.cumsum(np.exp(gaps))])
        p = _sigmoid((x @ w)[:, None] - cuts[None, :])
        # Likelihood of the grade: the difference of neighbouring cumulative probabilities.
        padded = np.column_stack([np.ones(len(x)), p, np.zeros(len(x))])
        rows = np.arange(len(x))
        mass = np.maximum(padded[rows, grade] - padded[rows, grade + 1], 1e-9)
        slope = np.column_stack([np.zeros(len(x)), p * (1 - p), np.zeros(len(x))])
        upper, lower = slope[rows, grade] / mass, slope[rows, grade + 1] / mass
        d_score = -weight * (upper - lower) / total
        d_cut = np.zeros(grades)
        np.add.at(d_cut, grade[above[:, 0] > 0] - 1, (weight * upper / total)[above[:, 0] > 0])
        low = grade < grades
        np.add.at(d_cut, grade[low], -(weight * lower / total)[low])
        later = np.cumsum(d_cut[::-1])[::-1]
        gradient = np.concatenate([x.T @ d_score + L2 * w, later[:1], later[1:] * np.exp(gaps)])
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        rate = 0.1 * (1 - step / STEPS) + 0.005
        parameters -= rate * (first / (1 - 0.9**step)) / (
            np.sqrt(second / (1 - 0.999**step)) + 1e-12
        )
    w, cut, gaps = np.split(parameters, [len(numbers), len(numbers) + 1])
    return SeverityModel(numbers, w, np.concatenate([cut, cut + np.cumsum(np.exp(gaps))]))


def train_severity(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    rows: int = TRAIN_ROWS,
) -> SeverityModel:
    """Fit on about ``rows`` labelled documents of each class, chosen by a hash of the id. The
    classes are weighted back to their shares among all labels. Labels other than 0 and 1 and
    labels without a document are not used; without any toxic label nothing is toxic."""
    known = labels.where(F.col("toxic").isin(0, 1)).select(
        F.col(id_column).alias("_id"), (F.col("toxic") == 1).alias("_toxic")
    )
    sizes = {r["_toxic"]: r["count"] for r in known.groupBy("_toxic").count().collect()}
    share = F.when(F.col("_toxic"), rows / max(1, sizes.get(True, 0))).otherwise(
        rows / max(1, sizes.get(False, 0))
    )
    place = F.pmod(F.xxhash64("_id", F.lit(3)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    few = known.where(place < share)
    texts = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts, classes = encoded(batch["_text"].to_pylist()), batch["_toxic"].to_pylist()
            for part in in_batches(texts):
                found = [f.tobytes() for f in features(texts[part])]
                yield pa.RecordBatch.from_pydict(
                    {"_toxic": pa.array(classes[part], pa.bool_()), "_found": pa.array(found, pa.binary())}
                )

    sample = (
        texts.join(F.broadcast(few), "_id")
        .select("_text", "_toxic")
        .mapInArrow(counted, "_toxic boolean, _found binary")
        .toArrow()
    )
    toxic = np.array(sample["_toxic"].to_pylist(), bool)
    # Views of the Arrow buffers, not copies.
    found = [np.frombuffer(f.as_buffer(), np.uint32) for f in sample["_found"]]
    if not toxic.any() or toxic.all():
        return SeverityModel(np.zeros(0, np.uint32), np.zeros(0), np.full(GRADES, 40.0))
    share_of = {flag: sizes[flag] / (toxic == flag).sum() for flag in (True, False)}
    return fit_severity(found, toxic, np.where(toxic, share_of[True], share_of[False]))


def toxicity(
    docs: DataFrame,
    model: SeverityModel,
    id_column: str = "doc_id",
    text_column: str = "text",
    cut: float = CUT,
) -> DataFrame:
    """``doc_id``, ``severity`` (the expected grade), ``grade`` (the likeliest one at ``cut``) and
    ``toxic``, for every row and its whole text. Null and empty texts have no features: they get
    the severity of a document without any, and stay. Repeated rows are scored alike, other
    columns are not read, no rows give no rows."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts, ids = encoded(batch["_text"].to_pylist()), batch["_id"]
            for part in in_batches(texts):
                p = model.at_least(list(features(texts[part])))
                grade = (p >= cut).sum(axis=1).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids[part],
                        pa.array(p.sum(axis=1)),
                        pa.array(grade),
                        pa.array(grade > 0),
                    ],
                    [id_column, "severity", "grade", "toxic"],
                )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")).mapInArrow(
        scored, f"`{id_column}` {kind}, severity double, grade int, toxic boolean"
    )


def without_toxic(
    docs: DataFrame, model: SeverityModel, text_column: str = "text", cut: float = CUT
) -> DataFrame:
    """The rows of ``docs`` that are not toxic, with their columns. The flag is computed beside
    the row, so rows are neither joined nor matched by id."""

    @F.arrow_udf("boolean")
    def toxic(texts: pa.Array) -> pa.Array:
        # A few texts at a time: a batch may hold thousands of long ones.
        flags = [np.zeros(0, bool)]
        for few in sliced([pa.RecordBatch.from_arrays([texts], ["_text"])]):
            whole = encoded(few["_text"].to_pylist())
            for part in in_batches(whole):
                flags.append(model.at_least(list(features(whole[part])))[:, 0] >= cut)
        return pa.array(np.concatenate(flags))

    return docs.where(~toxic(F.col(text_column)))
