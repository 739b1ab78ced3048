from itertools import product

import pytest
from pyspark.sql import functions as F

from samekin.operators.decisions import decide, decision_summary, matched_edges, score_summary
from samekin.plans.policy import BEHAVIORAL, IDENTIFIER, DecisionPolicy
from samekin.plans.resolution import decided_pairs, resolve_entities, scored_pairs
from samekin.operators.metrics import stage_funnel
from samekin.operators.report import entity_report, top_entities
from samekin.operators.blocking import DEFAULT_PASSES
from samekin.schema import TX_SCHEMA

SCORES = """leftTxId string, rightTxId string, nameSimilarity double, walletExactMatch boolean,
  amountRelativeDifference double, blockKey string, typeExactMatch boolean, timeDistance bigint"""

SETTINGS = {
    "version": "2.1",
    "nameSimilarityThreshold": 0.9,
    "amountRelativeTolerance": 0.2,
    "walletMatchEnabled": False,
    "requireTypeMatch": False,
    "maxStepDistance": 7,
    "evidenceMode": " identifier ",
}


def decided(spark, policy, *facts):
    rows = [(f"l{i:02d}", f"r{i:02d}", n, w, a, "k", t, s) for i, (n, w, a, t, s) in enumerate(facts)]
    found = decide(spark.createDataFrame(rows, SCORES), policy).orderBy("leftTxId").collect()
    return [(r["decision"], r["decisionReasons"]) for r in found]


def test_policy_from_settings():
    policy = DecisionPolicy.from_dict(SETTINGS)
    assert policy == DecisionPolicy("2.1", 0.9, 0.2, False, False, 7, IDENTIFIER)


@pytest.mark.parametrize(
    "change",
    [
        {"nameSimilarityThreshold": 1.01},
        {"nameSimilarityThreshold": -0.1},
        {"amountRelativeTolerance": 2},
        {"version": ""},
        {"maxStepDistance": -1},
        {"evidenceMode": "BOTH"},
        {"walletMatchEnabled": "yes"},
        {"maxStepDistance": 5.9},
        {"maxStepDistance": True},
        {"version": None},
        {"version": " "},
        {"amountRelativeTolerance": "0.1"},
        {"evidenceMode": 3},
    ],
)
def test_policy_rejects(change):
    with pytest.raises(ValueError):
        DecisionPolicy.from_dict({**SETTINGS, **change})


def test_policy_needs_every_setting():
    with pytest.raises(ValueError, match="maxStepDistance"):
        DecisionPolicy.from_dict({k: v for k, v in SETTINGS.items() if k != "maxStepDistance"})


def test_bounds_of_every_threshold(spark):
    (low, high, tolerant, late) = decided(
        spark,
        DecisionPolicy(),
        (0.84, False, 0.09, True, 5),
        (0.85, True, 0.1, True, 0),
        (1.0, True, 0.0, False, 5),
        (1.0, True, 0.0, True, 6),
    )
    assert low == (
        "MATCHED",
        [
            "AmountDeltaWithinTolerance(0.09,0.1)",
            "NameSimilarityBelowThreshold(0.84,0.85)",
            "StepWithinWindow(5,5)",
            "TypeMatched",
        ],
    )
    assert high == (
        "NOT_MATCHED",
        [
            "AmountDeltaAboveTolerance(0.1,0.1)",
            "ExactWalletMatch",
            "InsufficientEvidence",
            "NameSimilarityAboveThreshold(0.85,0.85)",
            "StepWithinWindow(0,5)",
            "TypeMatched",
        ],
    )
    assert tolerant[0] == late[0] == "NOT_MATCHED"
    assert "TypeMismatched" in tolerant[1] and "StepOutsideWindow(6,5)" in late[1]


def test_outcome_follows_from_the_facts(spark):
    facts = list(product([0.2, 0.9], [True, False], [0.05, 0.3], [True, False], [1, 9]))
    for mode, wallet_on, type_on in product([BEHAVIORAL, IDENTIFIER], [True, False], [True, False]):
        policy = DecisionPolicy(
            wallet_match_enabled=wallet_on, require_type_match=type_on, evidence_mode=mode
        )
        for (n, w, a, t, s), (decision, reasons) in zip(facts, decided(spark, policy, *facts)):
            required = a < 0.1 and s <= 5 and (t or not type_on)
            identified = n >= 0.85 or (w and wallet_on)
            strong = identified if mode == IDENTIFIER else required
            assert decision == ("MATCHED" if required and strong else "NOT_MATCHED")
            assert ("InsufficientEvidence" in reasons) == (not strong)
            assert ("ExactWalletMatch" in reasons) == (w and wallet_on)
            assert reasons == sorted(reasons)


def test_missing_values_never_match(spark):
    rows = [("a", "N", "w", 1.0, "T", 1), ("b", "N", None, None, None, None), ("c", "n", "w", 1.0, "t", 2)]
    table = spark.createDataFrame(rows, TX_SCHEMA)
    edges = matched_edges(decided_pairs(table, DecisionPolicy()))
    assert [tuple(r) for r in edges.collect()] == [("a", "c")]
    entities = resolve_entities(table, DecisionPolicy()).mapping
    assert sorted(map(tuple, entities.collect())) == [("a", "a"), ("c", "a")]


# Ten payments: two persons paying like amounts, one of them under two spellings; a refund; zeros.
PAYMENTS = [
    ("a9", "Émile Roy", "V1", 60.0, "WIRE", 100),
    ("a8", "émile roy", "V2", 62.5, "WIRE", 104),
    ("a7", "Emil Roy", "V3", 60.0, "wire ", 102),
    ("a6", "Kofi\tMensah", "V4", 60.0, "WIRE", 180),
    ("a5", "Kofi Mensah", "V4", 900.0, "CASH", 181),
    ("a4", "Kofi Mensah", "V5", 905.0, "CASH", 186),
    ("a3", "Kofi Mensah", "V5", -905.0, "CASH", 186),
    ("a2", "Lu", "V6", 0.0, "CASH", 3),
    ("a1", "Li", "V7", 0.0, "CASH", 5),
    ("a0", None, None, 60.0, None, 101),
]


def payments(spark):
    return spark.createDataFrame(PAYMENTS, TX_SCHEMA)


def test_scores_of_awkward_rows(spark):
    scores = {(r["leftTxId"], r["rightTxId"]): r for r in scored_pairs(payments(spark)).collect()}
    assert set(scores) == {
        ("a8", "a9"), ("a3", "a4"), ("a3", "a5"), ("a4", "a5"), ("a6", "a9"), ("a1", "a2"),
    }
    cased = scores["a8", "a9"]
    assert (cased["nameSimilarity"], cased["walletExactMatch"], cased["timeDistance"]) == (1.0, False, 4)
    assert cased["amountRelativeDifference"] == 0.04
    assert scores["a1", "a2"]["amountRelativeDifference"] == 0.0
    assert scores["a3", "a4"]["amountRelativeDifference"] == 2.0


def test_entities_and_funnel_of_awkward_rows(spark):
    table, policy = payments(spark), DecisionPolicy()
    mapping = resolve_entities(table, policy).mapping
    assert sorted(map(tuple, mapping.collect())) == [
        ("a1", "a1"), ("a2", "a1"), ("a4", "a4"), ("a5", "a4"), ("a8", "a8"), ("a9", "a8"),
    ]
    top = top_entities(table, mapping, 2).collect()
    assert [tuple(r) for r in top] == [("a4", 1805.0, "1,805", 2, 2), ("a8", 122.5, "122", 2, 2)]
    assert entity_report(table, mapping).count() == 3
    funnel = {r["stage"]: r["rows"] for r in stage_funnel(table, mapping, policy, DEFAULT_PASSES).collect()}
    assert funnel == {
        "transactions": 10,
        "pairs_exact_name": 4,
        "pairs_amount_type": 2,
        "pairs_deduplicated": 6,
        "matched_pairs": 3,
        "resolved_transactions": 6,
        "resolved_entities": 3,
    }


def test_summaries_count_kinds(spark):
    decisions = decided_pairs(payments(spark), DecisionPolicy())
    expected = {}
    for row in decisions.collect():
        for reason in row["decisionReasons"]:
            key = (row["decision"], reason.split("(")[0])
            expected[key] = expected.get(key, 0) + 1
    for found in (decision_summary(decisions), score_summary(scored_pairs(payments(spark)), DecisionPolicy())):
        assert {(r["decision"], r["reason"]): r["pairs"] for r in found.collect()} == expected


def test_summary_of_names_told_by_threshold(spark):
    """Equal to the one of all similarities, in either mode."""
    for policy in (DecisionPolicy(), DecisionPolicy(evidence_mode="IDENTIFIER", name_similarity_threshold=0.6)):
        whole = score_summary(scored_pairs(payments(spark)), policy)
        told = scored_pairs(payments(spark), least_name=policy.name_similarity_threshold)
        assert sorted(score_summary(told, policy).collect()) == sorted(whole.collect())


def test_matched_filter_reaches_the_join(spark):
    """Losing pairs are dropped inside the self-join, not after it."""
    plan = matched_edges(decided_pairs(payments(spark), DecisionPolicy()))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in text.splitlines() if "Join Inner" in line)
    assert "<= 5" in join and "0.1" in join


def test_reasons_come_sorted_without_a_sort_a_pair(spark):
    """In the order of a sort, and with the texts of a cast, for facts of two decimals and others."""
    facts = "nameSimilarity double, walletExactMatch boolean, amountRelativeDifference double, typeExactMatch boolean, timeDistance long"
    numbers = [0.0, 0.07, 0.29, 0.85, 1.0, 0.123456, 2.0, 3.5, float("nan")]
    rows = [("a", "b", n, w, d, w, t) for n in numbers for w in (True, False) for d in [*numbers, None] for t in (1, None)]
    scores = spark.createDataFrame(rows, f"leftTxId string, rightTxId string, {facts}")
    for mode in (BEHAVIORAL, IDENTIFIER):
        decided = decide(scores, DecisionPolicy(evidence_mode=mode))
        texts = decided.select(
            "decisionReasons",
            F.col("similarityScore.nameSimilarity").cast("string").alias("name"),
            F.coalesce(F.col("similarityScore.amountRelativeDifference").cast("string"), F.lit("null")).alias("amount"),
        )
        for r in texts.collect():
            assert r.decisionReasons == sorted(r.decisionReasons)
            assert any(x.startswith("Name") and x.endswith(f"Threshold({r.name},0.85)") for x in r.decisionReasons)
            assert any(x.startswith("Amount") and x.endswith(f"Tolerance({r.amount},0.1)") for x in r.decisionReasons)
        plan = decided._jdf.queryExecution().optimizedPlan().toString()
        assert "sort_array" not in plan and "lambda" not in plan


def test_names_are_normalized_a_row_for_amount_pairs(spark, tmp_path):
    from samekin import catalog

    columns = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"
    events = spark.createDataFrame([(i, None, i, "a", 1.0) for i in range(4)], columns)
    events.write.parquet(f"{tmp_path}/events.parquet")
    customers = spark.createDataFrame([(i, f"N. {i}") for i in range(4)], "c_custkey long, c_name string")
    customers.write.parquet(f"{tmp_path}/customer.parquet")
    scores = catalog.similarity_scores_amount(spark, str(tmp_path))
    plan = scores._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan[: plan.index("Join Inner")]
    assert sorted(r.nameSimilarity for r in scores.collect()) == [0.67] * 6
