"""Counting by a sweep against looking at all pairs."""

import random
from itertools import combinations

import numpy as np
import pytest

from samekin.operators.blocking import AMOUNT_PASS, NAME_PASS, BlockingPass
from samekin.operators.metrics import count_matches
from samekin.operators.sweep import close_below, count_at_most, is_close
from samekin.plans.policy import DecisionPolicy
from samekin.schema import TX_SCHEMA
from tests.brute_force import difference, matched_pairs
from pyspark.sql import functions as F


def test_count_at_most():
    rng = np.random.default_rng(1)
    for size in (0, 1, 2, 37, 300):
        ranks, weights = rng.integers(0, 20, size), rng.integers(1, 5, size)
        low = rng.integers(0, size + 1, 50)
        high = np.maximum(low, rng.integers(0, size + 1, 50))
        limit = rng.integers(0, 25, 50)
        found = count_at_most(ranks, weights, low, high, limit)
        expected = [weights[a:b][ranks[a:b] < k].sum() for a, b, k in zip(low, high, limit)]
        assert list(found) == expected


@pytest.mark.parametrize("passing", [0.0, 0.01, 0.09, 0.29, 0.99])
def test_closeness_is_that_of_the_facts(passing):
    rng = random.Random(2)
    cents = [rng.randrange(20_000) / 100 for _ in range(300)] + [0.0, 0.004, 0.005]
    for a, b in combinations(cents, 2):
        close = bool(is_close(np.array([a]), np.array([b]), close_below(passing))[0])
        assert close == (difference(a, b) <= passing)


@pytest.mark.parametrize("seed", range(6))
def test_counts_equal_all_pairs(spark, seed):
    rng = random.Random(seed)
    policy = DecisionPolicy(
        amount_relative_tolerance=rng.choice([0.0, 0.02, 0.1, 0.3, 1.0]) if seed else 0.0,
        max_step_distance=rng.choice([0, 1, 5, 40]),
        require_type_match=bool(seed % 2),
    )
    rows = []
    for i in range(400):
        amount = rng.choice([0.0, 7.5, 7.5, 8.25, -3.0, round(10 ** rng.uniform(-2, 2), 2)])
        kind, at = rng.choice(["A", "a ", "B", None]), rng.randrange(100) - 50
        rows.append((f"t{i}", rng.choice(["x", "X ", "y"]), "w", amount, kind, at))
    table = spark.createDataFrame(rows, TX_SCHEMA)
    expected = matched_pairs([dict(zip(TX_SCHEMA.names, r)) for r in rows], policy)
    assert count_matches(table, policy, (NAME_PASS, AMOUNT_PASS)).first()["rows"] == len(expected)


def test_one_large_block_of_distinct_rows(spark):
    """A million rows in one block; amounts all alike but different, so nearly all pairs of near times
    match."""
    n, per_hour, reach = 1_000_000, 2_500, 5
    table = spark.range(n).select(
        F.col("id").cast("string").alias("txId"),
        F.lit("one").alias("name"),
        F.lit("w").alias("wallet"),
        (100.0 + F.col("id") / 1e6).alias("amount"),
        F.lit("A").alias("txType"),
        F.pmod(F.col("id"), F.lit(n // per_hour)).alias("eventTime"),
    )
    hours = n // per_hour
    within = hours * per_hour * (per_hour - 1) // 2
    across = sum((hours - d) * per_hour**2 for d in range(1, reach + 1))
    passes = (BlockingPass("all", lambda: F.lit("all")),)
    found = count_matches(table, DecisionPolicy(max_step_distance=reach), passes)
    assert found.first()["rows"] == within + across
