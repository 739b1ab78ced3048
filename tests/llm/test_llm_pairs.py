"""Search and near duplicates against brute force."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from samekin.llm.jaccard import (
    allowed,
    bit_sketch,
    hamming,
    near_duplicates,
    one_of_each,
    shingle_sets,
    signatures,
)
from samekin.llm.topk import exact_top_k

VECTORS = "vec_id long, embedding array<float>, query_id string"


def brute_top_k(rows, k):
    usable = {}
    for vec_id, vector, _ in rows:
        if vec_id is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        numbers = tuple(math.floor(64 * x) for x in vector)
        usable[vec_id] = min(numbers, usable.get(vec_id, numbers))
    found = []
    for query, q in usable.items():
        if query % 20:
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(q, v)), i)
            for i, v in usable.items()
            if i != query and len(v) == len(q)
        )
        found += [(query, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(found)


@pytest.mark.parametrize("blocks", [(16_384, 1_024), (37, 3)])
def test_top_k_equals_brute_force(spark, blocks):
    rng = random.Random(5)
    centres = [[rng.gauss(0, 0.3) for _ in range(20)] for _ in range(6)]
    rows = []
    for i in range(300):
        centre = rng.choice(centres)
        rows.append((i, [c + rng.gauss(0, 0.05) for c in centre], "clash"))
    rows += [(300 + i, rows[7][1], "tie") for i in range(45)]
    rows += [
        (360, None, ""),
        (380, [1.0, None, 2.0], ""),
        (400, [float("nan")] * 20, ""),
        (420, [float("inf")] * 20, ""),
        (None, rows[1][1], ""),
        (440, [0.5, -0.5], ""),
        (441, [0.25, 1.0], ""),
        (460, [], ""),
        (461, [], ""),
        (3, rows[3][1], "again"),
    ]
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], s) for i, v, s in rows]
    table = spark.createDataFrame(rows, VECTORS).repartition(3)
    # The table's floats, as Spark holds them.
    held = [tuple(r) for r in table.collect()]
    found = exact_top_k(
        table, F.col("vec_id") % 20 == 0, candidate_rows=blocks[0], query_rows=blocks[1]
    )
    assert sorted(map(tuple, found.collect())) == brute_top_k(held, 20)


def test_top_k_of_large_numbers_and_of_nothing(spark):
    big = [(0, [1e7, 1.0], ""), (1, [1e7, -1.0], ""), (2, [1e30, 1.0], "")]
    found = exact_top_k(spark.createDataFrame(big, VECTORS), F.col("vec_id") == 0).collect()
    assert [r.vec_id for r in found] == [2, 1]
    assert found[0].score == 2**63 - 1
    assert found[1].score == 640_000_000**2 - 64 * 64
    none = exact_top_k(spark.createDataFrame([], VECTORS), F.col("vec_id") == 0)
    assert none.collect() == []


LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_classes(rows):
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= 75 * (len(sets[i]) + len(sets[j]) - shared):
                parent[find(i)] = find(j)
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        root = find(i)
        smallest[root] = min(smallest.get(root, doc_id), doc_id)
    return sorted(
        (doc_id, len(sets[i]), smallest[find(i)] if sets[i] else doc_id)
        for i, (doc_id, _) in enumerate(rows)
    )


def corpus(seed, groups, copies, size, edits):
    """Groups of near copies on both sides of the threshold, a shared passage, and singles."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    passage = [rng.choice(words) for _ in range(60)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.randrange(1, size))]
        for _ in range(rng.randrange(1, copies)):
            own = list(base)
            for _ in range(rng.randrange(edits)):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append(own)
        if rng.random() < 0.5:
            rows.append(base[: len(base) // 2] + passage + base[len(base) // 2 :])
    rng.shuffle(rows)
    return [(i * 7 % 100_003, " ".join(r)) for i, r in enumerate(rows)]


def check_classes(spark, rows, **sizes):
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_shingles", F.lit("x"))
    found = near_duplicates(table.repartition(3), **sizes)
    assert sorted(map(tuple, found.collect())) == brute_classes(rows)


def test_classes_equal_brute_force(spark):
    rows = corpus(1, 60, 9, 300, 12)
    rows += [(900_001, None), (900_002, ""), (900_003, " \n\t"), (900_004, "a b"), (900_005, "A  b"), (900_006, "b a")]
    rows += [(900_100 + i, rows[0][1]) for i in range(40)]
    rows += [(900_200, "word " * 30_000), (900_201, "WORD\t" * 29_000)]
    check_classes(spark, rows)


def test_classes_of_crowded_parts_equal_brute_force(spark):
    """Small limits, so that parts of the groups are crowded and compared by tiles."""
    check_classes(spark, corpus(2, 6, 60, 120, 12), run=3, tile=16)


def test_no_documents_no_classes(spark):
    table = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(table).collect() == []
    assert one_of_each(table).collect() == []


def test_one_of_each_keeps_columns_and_one_row(spark):
    text = "one two three four five six seven"
    rows = [(4, text, "x"), (2, text, "y"), (2, text, "z"), (9, None, "n"), (8, "", "n"), (None, text, "n"), (7, "other words", "o")]
    table = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    kept = one_of_each(table)
    assert kept.columns == table.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 2, 7, 8, 9]


def test_sketch_distance_is_at_most_the_symmetric_difference():
    rng = random.Random(3)
    for _ in range(200):
        words = [str(rng.randrange(50)) for _ in range(rng.randrange(1, 200))]
        other = words[: rng.randrange(len(words) + 1)] + [str(rng.randrange(9)) for _ in range(rng.randrange(9))]
        a, b = shingle_sets([" ".join(words).encode(), " ".join(other).encode()])
        if len(b):
            assert hamming(bit_sketch(a), bit_sketch(b)) <= len(set(a) ^ set(b))
    for x in range(1, 60):
        for y in range(1, 60):
            for shared in range(min(x, y) + 1):
                if 100 * shared >= 75 * (x + y - shared):
                    assert x + y - 2 * shared <= allowed(x, y)


@pytest.mark.parametrize("size", [4**10 - 1, 4**10, 3_000_000])
def test_signatures_of_millions_of_shingles(size):
    rng = np.random.default_rng(size)
    whole = np.unique(rng.integers(0, 1 << 63, size, np.uint64) * np.uint64(2))
    other = np.union1d(whole[size // 9 :], whole[: size // 9] + np.uint64(1))
    counters = np.ones(1 << 22, np.uint32)
    sent = [signatures(s, counters) for s in (whole, other)]
    assert all(len(np.unique(s)) == len(s) > len(whole) // 4 for s in sent)
    assert len(np.intersect1d(*sent))
