from itertools import combinations

import pytest
from pyspark.sql import functions as F

from samekin.operators import skew
from samekin.operators.blocking import (
    AMOUNT_PASS,
    NAME_PASS,
    PREFIX_PASS,
    BlockingPass,
    amount_type_key,
    block,
    block_sizes,
    cap_blocks,
    exact_name_key,
    sub_block,
)
from samekin.operators.metrics import cap_hit_rate, pair_counts, top_block_sizes
from samekin.operators.blocking import with_pass_keys
from samekin.operators.pairs import (
    candidate_pairs,
    multi_pass_pairs,
    one_row_per_id,
    union_and_deduplicate,
)
from samekin.schema import TX_SCHEMA


# Two payments of one person, a misspelt name, one amount under two types, rows without a key.
PEOPLE = [
    ("p1", "Zoë Ünal", "k1", 40.0, "CARD", 9),
    ("p2", "zoë ünal ", "k2", 40.0, "CARD", 11),
    ("p3", "Zoe Unal", "k3", 41.0, "CARD", 12),
    ("p4", "Bert", "k4", 40.0, "CASH", 9),
    ("p5", "Bertha", "k4", 40.004, "CASH", 300),
    ("p6", None, "k5", 40.0, "CARD", 9),
    ("p7", "Bert", None, None, "CASH", 9),
    ("p8", "", "k6", -40.0, None, 9),
]


def people(spark):
    return spark.createDataFrame(PEOPLE, TX_SCHEMA)


def keyed(spark, sizes):
    """Rows t0, t1, ... in blocks of the given sizes, and three rows without a key."""
    rows, n = [], 0
    for key, size in sizes.items():
        rows += [(f"t{n + i}", key) for i in range(size)]
        n += size
    rows += [(f"null{i}", None) for i in range(3)]
    return spark.createDataFrame(rows, "txId string, blockKey string")


SIZES = {"a": 1, "b": 2, "c": 5, "d": 40}


def ids(pairs):
    rows = pairs.select("left.txId", "right.txId").toDF("l", "r").collect()
    return sorted((r["l"], r["r"]) for r in rows)


@pytest.fixture(params=["broadcast", "hot", "shuffle"])
def lookup_path(request, monkeypatch):
    """Every way a per-key lookup can be joined gives the same rows."""
    if request.param != "broadcast":
        monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    if request.param == "hot":
        real = skew.hot_keys
        monkeypatch.setattr(skew, "hot_keys", lambda rows, key, n=0: real(rows, key, 3))


def test_every_pair_of_a_block_once_in_string_order(spark):
    pairs = candidate_pairs(keyed(spark, SIZES))
    found = ids(pairs)
    assert all(l < r for l, r in found)
    assert len(found) == len(set(found)) == sum(n * (n - 1) // 2 for n in SIZES.values())


@pytest.mark.parametrize("tile_rows", [1, 7])
def test_tiles_give_the_same_pairs(spark, tile_rows, lookup_path):
    table = keyed(spark, SIZES)
    assert ids(candidate_pairs(table, tile_rows)) == ids(candidate_pairs(table))


def test_cap_keeps_blocks_up_to_the_cap(spark, lookup_path):
    kept = cap_blocks(keyed(spark, SIZES), 5)
    assert {r[0]: r[1] for r in block_sizes(kept).collect()} == {"a": 1, "b": 2, "c": 5}


def test_sub_block_splits_large_blocks_only_and_loses_nothing(spark, lookup_path):
    table = keyed(spark, SIZES)
    split = sub_block(table, 5, F.substring("txId", -1, 1)).collect()
    assert len(split) == sum(SIZES.values())
    for row in split:
        large = row["blockKey"].startswith("d")
        assert row["blockKey"] == (f"d|sub:{row['txId'][-1]}" if large else row["blockKey"][0])


def test_hit_rate_and_top_blocks(spark):
    table = keyed(spark, SIZES)
    named = table.where("blockKey is not null")
    assert tuple(cap_hit_rate(named, 5).first()) == (4, 1, 25.0)
    assert tuple(cap_hit_rate(table, 5).first()) == (5, 2, 40.0)
    assert tuple(cap_hit_rate(named.limit(0), 5).first()) == (0, 0, 0.0)
    assert [tuple(r) for r in top_block_sizes(named, 2).collect()] == [("d", 40), ("c", 5)]


def test_union_keeps_one_row_per_unordered_pair(spark):
    schema = "left struct<txId:string>, right struct<txId:string>, blockKey string"
    first = spark.createDataFrame([(("a",), ("b",), "k2"), (("a",), ("c",), "k")], schema)
    second = spark.createDataFrame([(("b",), ("a",), "k1"), (("a",), ("b",), "k3")], schema)
    rows = union_and_deduplicate(first, second).collect()
    assert sorted((r["left"][0], r["right"][0], r["blockKey"]) for r in rows) == [
        ("a", "c", "k"),
        ("b", "a", "k1"),
    ]


def test_passes_together_equal_union_and_dedup(spark):
    sample = people(spark)
    passes = (PREFIX_PASS, NAME_PASS, BlockingPass("amount_type", amount_type_key, 3))
    single = [candidate_pairs(block(sample, p.key())) for p in passes[:2]]
    capped = candidate_pairs(cap_blocks(block(sample, amount_type_key()), 3))
    expected = union_and_deduplicate(*single, capped)
    together = multi_pass_pairs(sample, passes)

    def rows(pairs):
        chosen = pairs.select("left.txId", "right.txId", "blockKey").toDF("l", "r", "k")
        return sorted(map(tuple, chosen.collect()))

    assert rows(together) == rows(expected)
    counted = {r["stage"]: r["rows"] for r in pair_counts(with_pass_keys(sample, passes), passes).collect()}
    assert counted == {
        "pairs_name_prefix": single[0].count(),
        "pairs_exact_name": single[1].count(),
        "pairs_amount_type": capped.count(),
        "pairs_deduplicated": expected.count(),
    }
    shared = together.where("left.txId = 'p1' and right.txId = 'p2'").first()
    assert shared["passes"] == ["name_prefix", "exact_name", "amount_type"]


def test_blocks_of_awkward_rows(spark):
    by_amount = ids(candidate_pairs(block(people(spark), AMOUNT_PASS.key())))
    assert by_amount == sorted([*combinations(["p1", "p2", "p6"], 2), ("p4", "p5")])
    by_name = ids(candidate_pairs(block(people(spark), exact_name_key())))
    assert by_name == [("p1", "p2"), ("p4", "p7")]


def test_rows_with_the_same_id_become_one(spark):
    table = people(spark)
    doubled = one_row_per_id(table.unionByName(table))
    assert doubled.columns == table.columns
    assert sorted(map(str, doubled.collect())) == sorted(map(str, table.collect()))


def test_pass_names_stay_in_generated_code(spark):
    """Of two passes and of three, without a function over an array for each pair."""
    rows = spark.createDataFrame(PEOPLE, TX_SCHEMA)
    for passes in ((NAME_PASS, AMOUNT_PASS), (NAME_PASS, AMOUNT_PASS, PREFIX_PASS)):
        pairs = multi_pass_pairs(rows, passes)
        assert "lambda" not in pairs._jdf.queryExecution().optimizedPlan().toString()
        keys = with_pass_keys(rows, passes).collect()
        expected = {}
        for x, y in combinations(sorted(keys, key=lambda r: r["txId"]), 2):
            names = [p.name for i, p in enumerate(passes) if x[f"_key{i}"] is not None and x[f"_key{i}"] == y[f"_key{i}"]]
            if names:
                expected[x["txId"], y["txId"]] = names
        assert {(r["left"]["txId"], r["right"]["txId"]): r["passes"] for r in pairs.collect()} == expected
