import random

import pytest
from pyspark.sql import functions as F

from samekin.functions import similarity, text
from samekin.operators.blocking import amount_type_key, exact_name_key, prefix_key
from samekin.operators.matching import floor_div
from samekin.operators.scoring import NAME_CORE, with_name_cores
from tests import brute_force


def test_normalize_name(spark):
    cases = {
        "T0m Baker": "tOm baker",
        "Carl  Winter!": "carl winter",
        "  A\tB\nC ": "a b c",
        "José Ñ": "jos",
        "a-b_c.d": "abcd",
        "": "",
        "  ": "",
        None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "name string")
    rows = df.select("name", text.normalize_name(F.col("name")).alias("n")).collect()
    assert {r["name"]: r["n"] for r in rows} == cases


def test_wallet_and_type_lose_control_characters_too(spark):
    df = spark.createDataFrame([("\t \x01Ab c\n\x00",)], "x string")
    row = df.select(text.normalize_wallet(F.col("x")), text.normalize_type(F.col("x"))).first()
    assert tuple(row) == ("ab c", "AB C")


def test_block_keys(spark):
    df = spark.createDataFrame(
        [("B0b Smith", 1.005, "X"), (" Al ", -0.005, "y"), ("\tQ", 2.0, None)],
        "name string, amount double, txType string",
    )
    rows = df.select(prefix_key(), exact_name_key(), amount_type_key()).collect()
    assert [tuple(r) for r in rows] == [
        ("bbs", "b0b smith", "amt:100|type:X"),
        ("al", "al", "amt:-1|type:y"),
        ("q", "\tq", None),
    ]


def test_name_similarity_agrees_with_brute_force(spark):
    rng = random.Random(3)
    letters = "abO 0.é"
    pairs = [
        tuple("".join(rng.choices(letters, k=rng.randrange(9))) for _ in "lr") for _ in range(400)
    ] + [("Ellen Rye", "Ellen Ray"), ("", ""), ("!", "?"), (None, "a"), (None, None)]
    df = spark.createDataFrame(pairs, "l string, r string")
    normalized = [text.normalize_name(F.col(c)) for c in "lr"]
    rows = df.select("l", "r", similarity.name_similarity(*normalized).alias("s")).collect()
    assert [r["s"] for r in rows] == [brute_force.similarity(r["l"], r["r"]) for r in rows]


@pytest.mark.parametrize("seed", [1, 2])
def test_amount_difference_agrees_with_brute_force(spark, seed):
    rng = random.Random(seed)
    pairs = [(round(rng.uniform(-50, 200), 2), round(rng.uniform(0, 200), 2)) for _ in range(2000)]
    pairs += [(0.0, 0.0), (0.0, 1.0), (-2.0, 2.0), (100.0, 110.52), (0.0, -0.0)]
    df = spark.createDataFrame(pairs, "l double, r double")
    fact = similarity.amount_relative_difference(F.col("l"), F.col("r")).alias("d")
    rows = df.select("l", "r", fact).collect()
    assert [r["d"] for r in rows] == [brute_force.difference(r["l"], r["r"]) for r in rows]


def test_floor_div(spark):
    values = [-(2**62), -7, -3, -1, 0, 2, 3, 2**62 + 1]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    rows = df.select(floor_div(F.col("v"), 3)).collect()
    assert [r[0] for r in rows] == [v // 3 for v in values]


def test_two_decimals_round_as_decimals_do(spark):
    odd = [float("nan"), float("inf"), None, -0.0, -1.005, 2.0, 2.675, 0.145, 0.285, 1.005]
    values = spark.createDataFrame([(v,) for v in odd + [i / 1000 for i in range(2001)]], "v double")
    other = values.where(~F.round("v", 2).eqNullSafe(similarity.two_decimals(F.col("v"))))
    assert other.collect() == []
    number, edits = F.col("n").cast("double"), F.col("k").cast("double")
    ratios = spark.range(1, 121).select(F.col("id").alias("n")).crossJoin(spark.range(0, 121).select(F.col("id").alias("k")))
    ratios = ratios.where("k <= n and n % 8 <> 0").select((1.0 - edits / number).alias("v"))
    assert ratios.where(F.round("v", 2) != similarity._hundredths(F.col("v"))).collect() == []


def test_sketches_spare_edit_distances_but_lose_no_similar_name(spark):
    """Names that differ much get 0 unseen; those as similar as asked for, or more, their similarity."""
    draw = random.Random(5)
    names = ["", "a", "é", "😀 ab", None, *("".join(draw.choices("abcdefgh", k=draw.randint(1, 40))) for _ in range(30))]
    for name in names[5:]:
        for _ in range(draw.randint(1, 6)):
            at = draw.randint(0, len(name))
            name = name[:at] + draw.choice(["", "x", "é", "yz"]) + name[at + draw.randint(0, 1) :]
            names.append(name)
    rows = spark.createDataFrame([(n,) for n in names], "name string")
    rows = rows.withColumn("sketch", similarity.name_sketch("name"))
    left, right = (rows.withColumnsRenamed({"name": f"{s}n", "sketch": f"{s}s"}) for s in "lr")
    sides = [F.col(c) for c in ("ln", "rn")]
    for least in (0.0, 0.5, 0.85, 1.0):
        told = similarity.name_similarity_from(least, *sides, F.col("ls"), F.col("rs"))
        pairs = left.crossJoin(right).select(similarity.name_similarity(*sides).alias("exact"), told.alias("told"))
        wrong = F.when(F.col("exact") >= least, F.col("told") != F.col("exact")).otherwise(F.col("told") >= least)
        assert pairs.where(wrong | F.col("told").isNull()).isEmpty()
    sketched = similarity.name_similarity_from(0.85, F.lit("customerOOO123456"), F.lit("customerOOO907182"), F.col("ls"), F.col("rs"))
    pair = spark.createDataFrame([("customerOOO123456", "customerOOO907182")], "ln string, rn string")
    pair = pair.withColumns({"ls": similarity.name_sketch("ln"), "rs": similarity.name_sketch("rn")})
    assert pair.select(sketched).first()[0] == 0.0


@pytest.mark.parametrize(
    "names, cores",
    [
        (["cust 12 ab", "cust 345 ab", None, "cust  ab"], ["12", "345", None, ""]),
        (["aaa", "aa", "aaaa"], ["a", "", "aa"]),
        (["x\U0001f600é1", "x\U0001f600ü1", "x\U0001f600éé1"], ["é", "ü", "éé"]),
        (["ab", "", "abc"], ["ab", "", "abc"]),
        ([None, None], [None, None]),
    ],
)
def test_names_without_what_all_share_are_equally_far_apart(spark, names, cores):
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id int, nameNorm string")
    cored = with_name_cores(rows)
    assert [r[NAME_CORE] for r in cored.orderBy("id").collect()] == cores
    left, right = cored.alias("l"), cored.alias("r")
    plain = similarity.name_similarity(F.col("l.nameNorm"), F.col("r.nameNorm"))
    short = similarity.name_similarity(*[F.col(f"{side}.{c}") for c in ("nameNorm", NAME_CORE) for side in "lr"])
    pairs = left.crossJoin(right).select(plain.alias("plain"), short.alias("short")).collect()
    assert all(p.plain == p.short for p in pairs) and len(pairs) == len(names) ** 2
