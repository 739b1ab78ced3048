"""Entities from connecting edges are those of all matched pairs."""

import random

import pytest

from samekin.operators import skew
from samekin.operators.blocking import AMOUNT_PASS, NAME_PASS, PREFIX_PASS, BlockingPass, amount_type_key
from samekin.operators.components import resolve_components
from samekin.operators.linking import connecting_edges
from samekin.operators.matching import matched_edges_direct
from samekin.operators.metrics import count_matches
from samekin.plans.policy import BEHAVIORAL, IDENTIFIER, DecisionPolicy
from samekin.plans.resolution import decided_pairs, resolve_entities
from samekin.schema import TX_SCHEMA
from tests.brute_force import components, matched_pairs


def rows_of(seed, count, amounts, names, times, types=("A", "a ", "B", None)):
    """Rows with many near misses on every axis, drawn from small pools."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        rows.append(
            {
                "txId": f"{rng.randrange(10**6)}-{i}",
                "name": rng.choice(names),
                "wallet": rng.choice(["w1", " W1", "w2", "w3", None]),
                "amount": amounts(rng),
                "txType": rng.choice(types),
                "eventTime": rng.randrange(times) - times // 2,
            }
        )
    return rows


def money(rng):
    return round(rng.choice([1, 1, -1]) * 10 ** rng.uniform(-2, 2), 2)


def dense(rng):
    return round(100 + rng.uniform(0, 40), 2)


def fine(rng):
    return rng.choice([0.0, -0.0, 0.001, 0.004, 0.0041, 0.0045, 0.005, 1.0049, 1.0051])


NAMES = ["Ann Lee", "ann lee ", "Ann Le", "Bo", "B0", None, ""]

CASES = [
    # amounts, tolerance, max step, require type, mode, time range, cap
    (money, 0.10, 5, True, BEHAVIORAL, 400, 500),
    (money, 0.10, 5, True, BEHAVIORAL, 400, 3),
    (dense, 0.10, 3, True, BEHAVIORAL, 300, 500),
    (dense, 0.02, 10, False, BEHAVIORAL, 400, 500),
    (dense, 0.01, 40, True, BEHAVIORAL, 4000, 500),
    (dense, 0.105, 0, True, BEHAVIORAL, 12, 500),
    (money, 1.00, 2, True, BEHAVIORAL, 300, 500),
    (fine, 0.10, 2, True, BEHAVIORAL, 200, 500),
    (fine, 0.0, 2, True, BEHAVIORAL, 50, 500),
    (dense, 0.10, 3, True, IDENTIFIER, 100, 500),
    (fine, 0.10, 3, True, IDENTIFIER, 60, 500),
]

# Cases in which all matches are listed and counted as well.
LISTED = (1, 3, 4, 7, 8, 10)


@pytest.mark.parametrize(
    "case, hot_rows",
    [(case, skew.HOT_ROWS) for case in range(len(CASES))] + [(3, 2)],
)
def test_same_entities_as_all_matched_pairs(spark, case, hot_rows):
    amounts, tolerance, step, require_type, mode, times, cap = CASES[case]
    policy = DecisionPolicy(
        amount_relative_tolerance=tolerance,
        max_step_distance=step,
        require_type_match=require_type,
        evidence_mode=mode,
    )
    rows = rows_of(case, 350, amounts, NAMES, times)
    passes = (NAME_PASS, BlockingPass("amount_type", amount_type_key, cap))
    expected = matched_pairs(rows, policy, cap)
    table = spark.createDataFrame([tuple(r.values()) for r in rows], TX_SCHEMA)

    edges = connecting_edges(table, policy, passes, hot_rows=hot_rows).collect()
    assert components([tuple(e) for e in edges]) == components(expected)
    if mode == BEHAVIORAL:
        assert len(edges) <= 6 * len(rows)
    if case in LISTED and hot_rows != 2:
        tile_rows = 3 if case % 2 else None
        listed = matched_edges_direct(table, policy, passes, tile_rows)
        direct = [tuple(e) for e in listed.collect()]
        assert len(direct) == len(set(direct))
        assert set(direct) == expected
        assert count_matches(table, policy, passes).first()["rows"] == len(expected)


def test_one_group_holding_most_rows_gives_few_edges(spark):
    rows = rows_of(7, 3000, dense, ["Only One"], 60, types=("A",))
    table = spark.createDataFrame([tuple(r.values()) for r in rows], TX_SCHEMA)
    policy = DecisionPolicy()
    edges = connecting_edges(table, policy, (NAME_PASS, AMOUNT_PASS))
    listed = matched_edges_direct(table, policy, (NAME_PASS, AMOUNT_PASS))
    assert edges.count() < 3 * len(rows) < listed.count() / 10
    found = {r[0]: r[1] for r in resolve_components(edges).mapping.collect()}
    assert found == components(matched_pairs(rows, policy))


def test_a_row_leading_a_cell_in_both_passes_keeps_them_apart(spark):
    """x leads a name cell and an amount cell; only the latter has a time that z could reach."""
    rows = [
        ("x", "Ann", "w", 100.0, "A", 0),
        ("y", "Ann", "w", 96.0, "A", 2),
        ("z", "Ann", "w", 108.0, "A", 7),
        ("xx", "Bob", "w", 100.0, "A", 3),
    ]
    table = spark.createDataFrame(rows, TX_SCHEMA)
    named = [dict(zip(TX_SCHEMA.names, r)) for r in rows]
    expected = components(matched_pairs(named, DecisionPolicy()))
    edges = connecting_edges(table, DecisionPolicy(), (NAME_PASS, AMOUNT_PASS)).collect()
    assert components([tuple(e) for e in edges]) == expected == {"x": "x", "y": "x", "xx": "x"}


def test_duplicate_ids_do_not_link_to_themselves(spark):
    row = ("x", "Ann", "w", 10.0, "A", 1)
    table = spark.createDataFrame([row, row], TX_SCHEMA)
    assert connecting_edges(table, DecisionPolicy(), (NAME_PASS, AMOUNT_PASS)).count() == 0


@pytest.mark.parametrize("rows", [500, 501, 25_000])
def test_blocks_of_any_size_resolve_whole(spark, rows):
    """Equal amounts and types: one block, one entity, whatever its size."""
    table = spark.range(rows).selectExpr(
        "cast(id as string) as txId", "concat('n', id) as name", "concat('w', id) as wallet",
        "7.5D as amount", "'A' as txType", "id % 5 as eventTime",
    )
    mapping = resolve_entities(table, DecisionPolicy()).mapping
    assert mapping.count() == rows
    assert [r[0] for r in mapping.select("resolvedEntityId").distinct().collect()] == ["0"]


def test_copies_of_a_row_count_once(spark):
    """Two copies each of two matching rows are one pair, one edge and one match."""
    rows = [("x", "Ann", "w", 10.0, "A", 1), ("y", "Ann", "w", 10.0, "A", 2)] * 2
    table = spark.createDataFrame(rows, TX_SCHEMA)
    passes = (NAME_PASS, AMOUNT_PASS)
    assert decided_pairs(table, DecisionPolicy(), passes).count() == 1
    assert [tuple(r) for r in matched_edges_direct(table, DecisionPolicy(), passes).collect()] == [("x", "y")]
    assert count_matches(table, DecisionPolicy(), passes).first()["rows"] == 1


@pytest.mark.parametrize("letters, lengths, steps, most", [(5, (4,), (0, 1), 4), (9, (1, 2, 6), (0, 0, 1, 2, 9), None)])
def test_crowded_names_give_few_edges_with_the_same_entities(spark, letters, lengths, steps, most):
    """Names of one block differ in a few letters. Where they are dense, a row takes part in a few edges and
    not in one for each way to leave out two letters; rows far from most others are found as well."""
    rng = random.Random(letters)
    rows = []
    for i in range(400):
        tail = "".join(rng.choice("abcdefghi"[:letters]) for _ in range(rng.choice(lengths)))
        amount = round(100 * 1.3 ** rng.choice(steps) * rng.uniform(1, 1.2), 2)
        at = 24 * rng.randrange(3) + (5000 if i % 50 == 0 else 0)
        rows.append((f"t{i}", f"customer{tail}ooooo", f"w{i}", amount, rng.choice("AB"), at))
    table = spark.createDataFrame(rows, TX_SCHEMA)
    policy = DecisionPolicy(evidence_mode=IDENTIFIER, max_step_distance=24)
    listed = matched_edges_direct(table, policy, (PREFIX_PASS,)).collect()
    expected = components([tuple(e) for e in listed])
    edges = connecting_edges(table, policy, (PREFIX_PASS,), names_together=3).collect()
    assert components([tuple(e) for e in edges]) == expected
    assert len(set(expected.values())) > 1
    if most:
        assert len(edges) <= most * len(rows)
