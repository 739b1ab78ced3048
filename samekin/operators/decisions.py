"""Policy decisions: facts to readable reasons, reasons to MATCHED or NOT_MATCHED."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samekin.plans.policy import IDENTIFIER, DecisionPolicy

# The two outcomes.
MATCHED = "MATCHED"
NOT_MATCHED = "NOT_MATCHED"


@dataclass(frozen=True)
class Evidence:
    """What the policy reads off the facts of a pair; every column is true or false."""

    wallet: Column
    name_above: Column
    amount_within: Column
    type_matched: Column
    step_within: Column
    strong: Column
    matched: Column


def evidence(facts: dict[str, Column], policy: DecisionPolicy) -> Evidence:
    def certain(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False))

    wallet = facts["walletExactMatch"] & F.lit(policy.wallet_match_enabled)
    name_above = facts["nameSimilarity"] >= F.lit(policy.name_similarity_threshold)
    amount_within = certain(
        facts["amountRelativeDifference"] < F.lit(policy.amount_relative_tolerance)
    )
    type_matched = facts["typeExactMatch"]
    step_within = certain(facts["timeDistance"] <= F.lit(policy.max_step_distance))

    # Amount and time, and the type if required, must agree in either mode; the identifier
    # mode asks for a wallet or name match on top of that.
    required = amount_within & step_within
    if policy.require_type_match:
        required = required & type_matched
    strong = wallet | name_above if policy.evidence_mode == IDENTIFIER else required
    return Evidence(
        wallet, name_above, amount_within, type_matched, step_within, strong, required & strong
    )


def _reason(name: str, *values: Column) -> Column:
    if not values:
        return F.lit(name)
    shown = [F.coalesce(v.cast("string"), F.lit("null")) for v in values]
    parted = [part for value in shown for part in (F.lit(","), value)][1:]
    return F.concat(F.lit(f"{name}("), *parted, F.lit(")"))


def reasons(facts: dict[str, Column], policy: DecisionPolicy) -> Column:
    """Sorted reason strings. The reason names and their ``Name(x,y)`` form."""
    seen = evidence(facts, policy)
    name = [facts["nameSimilarity"], F.lit(float(policy.name_similarity_threshold))]
    amount = [facts["amountRelativeDifference"], F.lit(float(policy.amount_relative_tolerance))]
    step = [facts["timeDistance"], F.lit(policy.max_step_distance).cast("long")]
    none = F.array().cast("array<string>")
    # In the order of the names, which differ by their first letters, so that pairs need not sort them.
    return F.concat(
        F.array(
            F.when(seen.amount_within, _reason("AmountDeltaWithinTolerance", *amount)).otherwise(
                _reason("AmountDeltaAboveTolerance", *amount)
            )
        ),
        F.when(seen.wallet, F.array(_reason("ExactWalletMatch"))).otherwise(none),
        F.when(~seen.strong, F.array(_reason("InsufficientEvidence"))).otherwise(none),
        F.array(
            F.when(seen.name_above, _reason("NameSimilarityAboveThreshold", *name)).otherwise(
                _reason("NameSimilarityBelowThreshold", *name)
            ),
            F.when(seen.step_within, _reason("StepWithinWindow", *step)).otherwise(
                _reason("StepOutsideWindow", *step)
            ),
            F.when(seen.type_matched, _reason("TypeMatched")).otherwise(_reason("TypeMismatched")),
        ),
    )


FACT_COLUMNS = [
    "nameSimilarity",
    "walletExactMatch",
    "amountRelativeDifference",
    "typeExactMatch",
    "timeDistance",
]


def decide(scores: DataFrame, policy: DecisionPolicy) -> DataFrame:
    """One decision per scored pair, with its facts, sorted reasons and the policy version."""
    facts = {name: F.col(name) for name in FACT_COLUMNS}
    outcome = F.when(evidence(facts, policy).matched, F.lit(MATCHED)).otherwise(F.lit(NOT_MATCHED))
    return scores.select(
        "leftTxId",
        "rightTxId",
        F.struct(*scores.columns).alias("similarityScore"),
        reasons(facts, policy).alias("decisionReasons"),
        outcome.alias("decision"),
        F.lit(policy.policy_version).alias("policyVersion"),
    )


def matched_only(decisions: DataFrame) -> DataFrame:
    return decisions.where(F.col("decision") == MATCHED)


def matched_edges(decisions: DataFrame) -> DataFrame:
    """Distinct ``src``, ``dst`` of the matched pairs, without self-loops."""
    edges = matched_only(decisions).select(
        F.col("leftTxId").alias("src"), F.col("rightTxId").alias("dst")
    )
    return edges.where(F.col("src") != F.col("dst")).distinct()


def decision_summary(decisions: DataFrame) -> DataFrame:
    """Pairs per decision and reason kind (the reason without its values).

    Pairs are counted per combination of kinds first, of which there are a few dozen, and only
    the combinations are taken apart.
    """
    kinds = F.regexp_replace(F.array_join("decisionReasons", ";"), r"\([^)]*\)", "")
    return (
        decisions.select("decision", kinds.alias("kinds"))
        .groupBy("decision", "kinds")
        .agg(F.count("*").alias("pairs"))
        .select("decision", F.explode(F.split("kinds", ";")).alias("reason"), "pairs")
        .groupBy("decision", "reason")
        .agg(F.sum("pairs").alias("pairs"))
    )


def score_summary(scores: DataFrame, policy: DecisionPolicy) -> DataFrame:
    """:func:`decision_summary` straight from scored pairs: they are counted per combination of
    yes-or-no findings, and reasons are named for the few combinations only."""
    seen = evidence({name: F.col(name) for name in FACT_COLUMNS}, policy)
    flags = {
        "wallet": seen.wallet,
        "name": seen.name_above,
        "amount": seen.amount_within,
        "type": seen.type_matched,
        "step": seen.step_within,
        "strong": seen.strong,
        "matched": seen.matched,
    }
    # As one number, since pairs are many and a number is grouped by faster than seven columns.
    bits = [F.when(flag, F.lit(1 << i)).otherwise(F.lit(0)) for i, flag in enumerate(flags.values())]
    found = [(F.col("flags").bitwiseAND(F.lit(1 << i)) != 0).alias(f) for i, f in enumerate(flags)]
    counted = (
        scores.select(reduce(add, bits).alias("flags"))
        .groupBy("flags")
        .agg(F.count("*").alias("pairs"))
        .select(*found, "pairs")
    )

    def either(flag: str, yes: str, no: str) -> Column:
        return F.when(F.col(flag), yes).otherwise(no)

    kinds = F.array(
        F.when(F.col("wallet"), "ExactWalletMatch"),
        either("name", "NameSimilarityAboveThreshold", "NameSimilarityBelowThreshold"),
        either("amount", "AmountDeltaWithinTolerance", "AmountDeltaAboveTolerance"),
        either("type", "TypeMatched", "TypeMismatched"),
        either("step", "StepWithinWindow", "StepOutsideWindow"),
        F.when(~F.col("strong"), "InsufficientEvidence"),
    )
    return (
        counted.select(
            either("matched", MATCHED, NOT_MATCHED).alias("decision"),
            F.explode(F.array_compact(kinds)).alias("reason"),
            "pairs",
        )
        .groupBy("decision", "reason")
        .agg(F.sum("pairs").alias("pairs"))
    )
