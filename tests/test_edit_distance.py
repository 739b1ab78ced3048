"""The edit-distance join, and entities by name and wallet, against looking at all pairs."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from samekin.operators.blocking import BlockingPass
from samekin.operators.edit_distance import cover_keys, covered_lengths, similar_names
from samekin.operators.linking import connecting_edges
from samekin.plans.policy import IDENTIFIER, DecisionPolicy
from samekin.schema import TX_SCHEMA
from tests.brute_force import components, edit_distance, matches, two_decimals


def names_of(rng, count):
    """Names around a few stems, with edits at all places, and short ones."""
    stems = ["anna maria lopez", "anna mariah lopes", "bo", "", "a", "abcabcabcabc", "aaaaaaaaaaaaaaaaaaaaaaa"]
    found = ["", "a", "b", "ab", None]
    while len(found) < count:
        name = list(rng.choice(stems))
        for _ in range(rng.randrange(5)):
            at = rng.randrange(len(name) + 1)
            name[at : at + rng.randrange(2)] = rng.choice(["", "a", "b", "z"])
        found.append("".join(name))
    return found


@pytest.mark.parametrize(
    "threshold, tile_rows", [(1.0, None), (0.9, 7), (0.85, None), (0.85, 7), (0.6, 7), (0.3, None), (0.004, 7)]
)
def test_similar_names_are_found_once(spark, threshold, tile_rows):
    rng = random.Random(int(threshold * 1000))
    rows = [(f"t{i}", n, rng.randrange(2)) for i, n in enumerate(names_of(rng, 90))]
    table = spark.createDataFrame(rows, "txId string, name string, k int")
    found = similar_names(table, table, ["k"], "name", threshold, tile_rows=tile_rows)
    pairs = [tuple(sorted(r)) for r in found.select("l.txId", "r.txId").collect()]
    expected = set()
    for (i, a, k), (j, b, m) in combinations(rows, 2):
        if k == m and a != b and None not in (a, b):
            longer = max(len(a), len(b))
            if two_decimals(1.0 - edit_distance(a, b) / longer) >= threshold:
                expected.add(tuple(sorted((i, j))))
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == expected


def test_all_names_are_refused(spark):
    table = spark.createDataFrame([("t", "a")], "txId string, name string")
    with pytest.raises(ValueError):
        similar_names(table, table, [], "name", 0.0)


@pytest.mark.parametrize("threshold", [0.85, 0.7])
def test_similar_names_of_equal_length_share_a_cover_key(spark, threshold):
    """Also names that all share their beginning and end; what is shared makes no keys."""
    rng = random.Random(int(threshold * 100))
    names = {"ab" + "".join(rng.choice("xy1") for _ in range(n)) + "cd" for n in (1, 3, 4, 6, 8) for _ in range(14)}
    lengths = covered_lengths(threshold)
    table = spark.createDataFrame([(n,) for n in sorted(names)], "name string")
    keys = cover_keys(F.col("name"), F.lit(2), F.lit(2), lengths)
    found = {r[0]: set(r[1]) for r in table.select("name", keys).collect()}
    assert max(map(len, found.values())) <= 28 + 8
    for a, b in combinations(sorted(names), 2):
        if len(a) == len(b) and len(a) in lengths:
            similar = two_decimals(1.0 - edit_distance(a, b) / len(a)) >= threshold
            assert bool(found[a] & found[b]) == similar, (a, b)


ONE_BLOCK = BlockingPass("all", lambda: F.lit("all"))


@pytest.mark.parametrize(
    "threshold, wallets, names_together, times",
    [(0.85, True, 256, 60), (0.85, False, 2, 60), (0.6, False, 3, 12), (0.3, True, 1, 30), (0.0, False, 2, 60)],
)
def test_entities_of_one_block(spark, threshold, wallets, names_together, times):
    """All rows in one block; matches need a similar name or the same wallet."""
    rng = random.Random(times)
    policy = DecisionPolicy(
        name_similarity_threshold=threshold,
        wallet_match_enabled=wallets,
        evidence_mode=IDENTIFIER,
        max_step_distance=3,
    )
    names = names_of(rng, 60)
    rows = [
        (
            f"{rng.randrange(10**6)}-{i}",
            rng.choice(names),
            rng.choice(["w1", " W1", None, *[f"v{k}" for k in range(40)]]),
            round(100 + rng.uniform(0, 40), 2),
            rng.choice(["A", "a ", "B", None]),
            rng.randrange(times) - times // 2,
        )
        for i in range(250)
    ]
    table = spark.createDataFrame(rows, TX_SCHEMA)
    named = [dict(zip(TX_SCHEMA.names, r)) for r in rows]
    expected = [(a["txId"], b["txId"]) for a, b in combinations(named, 2) if matches(a, b, policy)]
    edges = connecting_edges(table, policy, (ONE_BLOCK,), names_together=names_together).collect()
    assert components(expected) == components([tuple(e) for e in edges])
