import random

import pytest

from samekin.operators.components import (
    _unsettled,
    contract_to_stars,
    grow_components,
    propagate_labels,
    resolve_components,
    symmetric_edges,
)
from samekin.operators.blocking import DEFAULT_PASSES
from samekin.operators.matching import matched_edges_direct
from samekin.plans import resolution
from samekin.plans.policy import DecisionPolicy
from samekin.schema import TX_SCHEMA
from tests.brute_force import components

EDGES = "src string, dst string"


def table(spark, edges):
    return spark.createDataFrame(edges, EDGES)


def mapping_of(found):
    rows = [tuple(r) for r in found.mapping.select("txId", "resolvedEntityId").collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


CHAIN = [(f"n{i}", f"n{i + 1}") for i in range(1, 8)]
SHAPES = {
    "single": [("b", "a")],
    "chain": CHAIN,
    "star": [("m", x) for x in "abcxyz"],
    "cycle": [("a", "b"), ("b", "c"), ("c", "d"), ("d", "a")],
    "two": [("a", "b"), ("y", "z")],
    "repeated": [("a", "b"), ("b", "a"), ("a", "b")],
    "self_loop": [("a", "a"), ("b", "c")],
    # As strings "10" is smaller than "9".
    "string_order": [("9", "10"), ("10", "200")],
}


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("leaf_rows", [0, 10**6])
def test_shapes(spark, shape, leaf_rows):
    edges = SHAPES[shape]
    expected = components([e for e in edges if e[0] != e[1]])
    found = contract_to_stars(table(spark, edges), leaf_rows=leaf_rows)
    assert mapping_of(found) == expected
    assert not found.rounds or found.rounds[-1] == 0


def test_no_edges(spark):
    found = resolve_components(table(spark, []))
    assert mapping_of(found) == {} and found.rounds == []
    assert mapping_of(propagate_labels(table(spark, []))) == {}


@pytest.mark.parametrize("seed, hot_rows", [(1, 10**6), (2, 3)])
def test_random_graph_with_hubs(spark, seed, hot_rows):
    rng = random.Random(seed)
    ids = [str(rng.randrange(10**6)) for _ in range(300)]
    edges = [(rng.choice(ids), rng.choice(ids)) for _ in range(170)]
    edges += [("5hub", rng.choice(ids)) for _ in range(60)]
    expected = components([e for e in edges if e[0] != e[1]])
    found = contract_to_stars(table(spark, edges), hot_rows=hot_rows, leaf_rows=hot_rows)
    assert mapping_of(found) == expected
    converged = propagate_labels(table(spark, edges), hot_rows)
    assert mapping_of(converged) == expected
    assert converged.rounds[-1] == 0


def test_propagation_takes_a_round_a_hop(spark):
    found = propagate_labels(table(spark, CHAIN))
    assert set(mapping_of(found).values()) == {"n1"}
    assert found.rounds == [7, 6, 5, 4, 3, 2, 1, 0]


def test_a_long_chain_takes_few_rounds(spark):
    edges = [(f"{i:04d}", f"{i + 1:04d}") for i in range(400)]
    found = resolve_components(table(spark, edges))
    assert set(mapping_of(found).values()) == {"0000"}
    assert len(found.rounds) <= 12


def test_symmetric_edges(spark):
    both = symmetric_edges(table(spark, [("a", "b"), ("b", "a"), ("c", "c")]))
    assert sorted(map(tuple, both.collect())) == [("a", "b"), ("b", "a")]


@pytest.mark.parametrize("hot_rows", [1, 10_000])
def test_grown_components_equal_those_of_all_edges(spark, hot_rows):
    rng = random.Random(hot_rows)
    edges = [(f"n{rng.randrange(150)}", f"n{rng.randrange(150)}") for _ in range(120)]
    edges += [("n1", "n1"), ("new", "new"), ("n2", "z"), ("z", "y")]
    first, more = edges[:60], edges[60:]
    table = lambda rows: spark.createDataFrame(rows, "src string, dst string")
    mapping = contract_to_stars(table(first)).mapping
    grown = {r[0]: r[1] for r in grow_components(mapping, table(more), hot_rows).mapping.collect()}
    whole = {r[0]: r[1] for r in contract_to_stars(table(edges)).mapping.collect()}
    assert grown == whole
    nothing = grow_components(mapping, table(more).limit(0), hot_rows).mapping
    assert {tuple(r) for r in nothing.collect()} == {tuple(r) for r in mapping.collect()}


@pytest.mark.parametrize("settle_rows", [0, 10**6])
@pytest.mark.parametrize("seed, hot_rows", [(1, 10**6), (2, 3), (3, 10**6)])
def test_propagation_counts_the_changes_of_each_round(spark, seed, hot_rows, settle_rows):
    """Dense groups, chains of them and chains, with edges that repeat: mapping and changes a round as by hand."""
    rng = random.Random(seed)
    edges = [(f"c{i}", f"c{i + 1}") for i in range(9)]
    for group in range(6):
        members = [f"{rng.randrange(10**5)}g{group}{i}" for i in range(5)]
        edges += [(a, b) for a in members for b in members if a != b]
        edges += [(members[0], f"t{group}"), (f"t{group}", f"{rng.randrange(9)}u{group // 2}")]
    edges += [(f"{rng.randrange(80)}", f"{rng.randrange(80)}") for _ in range(60)]
    near = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    labels, changes = {v: v for v in near}, []
    while not changes or changes[-1]:
        now = {v: min(labels[v], *(labels[u] for u in near[v])) for v in near}
        changes.append(sum(now[v] != labels[v] for v in near))
        labels = now
    found = propagate_labels(table(spark, edges), hot_rows, settle_rows)
    assert mapping_of(found) == labels
    assert found.rounds == changes


def test_propagation_leaves_settled_groups_out_of_the_rounds(spark):
    members = [f"m{i:02d}" for i in range(12)]
    edges = [(a, b) for a in members for b in members if a < b] + [("x1", "x2"), ("x2", "x3")]
    numbered = [(members.index(b) + 1, 1, members.index(a) + 1, 1) for a, b in edges[:66]]
    # x2 and x3 are 22 and 23, with the labels of the first round.
    numbered += [(22, 21, 21, 21), (23, 22, 22, 21)]
    pairs = spark.createDataFrame(numbered, "hi_n long, hi_label long, lo_n long, lo_label long")
    left = _unsettled(pairs, 10**6).select("hi_n", "lo_n").collect()
    assert {tuple(r) for r in left} == {(23, 22)}
    assert propagate_labels(table(spark, edges), settle_rows=0).rounds == [13, 1, 0]


def test_entities_by_propagation_of_numbers(spark, monkeypatch):
    """Ids are numbers, in the order of the texts, before pairs are made of them; rounds and entities are
    those of the texts. Ids may be missing or repeat."""
    rng = random.Random(5)
    rows = [
        (str(rng.randrange(400)), rng.choice(["Ann", "Bo", "Cy", None]), "w", rng.choice([10.0, 10.4, 12.0, 30.0]), "A", 6 * i)
        for i in range(120)
    ]
    rows += [(None, "Ann", "w", 10.0, "A", 3), rows[0]]
    transactions = spark.createDataFrame(rows, TX_SCHEMA)
    policy = DecisionPolicy(max_step_distance=24)
    expected = propagate_labels(matched_edges_direct(transactions, policy, DEFAULT_PASSES))
    given = []

    def propagated(edges):
        given.append(dict(edges.dtypes))
        return propagate_labels(edges, settle_rows=len(given) % 2 * 10**6)

    monkeypatch.setattr(resolution, "propagate_labels", propagated)
    for _ in range(2):
        found = resolution.propagate_entities(transactions, policy)
        assert mapping_of(found) == mapping_of(expected)
        assert found.rounds == expected.rounds and len(found.rounds) > 2
    assert given == [{"src": "bigint", "dst": "bigint"}] * 2
