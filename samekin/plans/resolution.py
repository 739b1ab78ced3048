"""The whole chain, put together from the operators. Every stage is a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samekin.operators import decisions as D
from samekin.operators.blocking import DEFAULT_PASSES, BlockingPass
from samekin.operators.components import Components, named_back, number_ids, propagate_labels, resolve_components
from samekin.operators.linking import connecting_edges
from samekin.operators.matching import matched_edges_direct, prepared
from samekin.operators.pairs import multi_pass_pairs, one_row_per_id
from samekin.operators.skew import measured, reused
from samekin.operators.scoring import similarity_scores, with_match_features, with_name_cores, with_name_sketches
from samekin.plans.policy import DecisionPolicy

# Fixed value of the standard run: the length of the report.
TOP_ENTITIES = 20


def scored_pairs(
    transactions: DataFrame,
    passes: tuple[BlockingPass, ...] = DEFAULT_PASSES,
    least_name: float | None = None,
) -> DataFrame:
    """Facts of every deduplicated candidate pair of all passes. For a reader that only asks whether names
    are at least ``least_name`` similar, edit distances are computed where sketches leave that open, and
    a similarity below it is told as something below."""
    features = with_match_features(one_row_per_id(transactions))
    features = with_name_cores(features) if least_name is None else with_name_sketches(features)
    return similarity_scores(multi_pass_pairs(features, passes), least_name)


def decided_pairs(
    transactions: DataFrame,
    policy: DecisionPolicy,
    passes: tuple[BlockingPass, ...] = DEFAULT_PASSES,
) -> DataFrame:
    """A decision with reasons for every candidate pair, matched or not."""
    return D.decide(scored_pairs(transactions, passes), policy)


def resolve_entities(
    transactions: DataFrame,
    policy: DecisionPolicy,
    passes: tuple[BlockingPass, ...] = DEFAULT_PASSES,
) -> Components:
    """Transactions to entities, to convergence, by a connecting set of edges."""
    with reused() as keep:
        return resolve_components(connecting_edges(transactions, policy, passes, keep))


def propagate_entities(
    transactions: DataFrame,
    policy: DecisionPolicy,
    passes: tuple[BlockingPass, ...] = DEFAULT_PASSES,
) -> Components:
    """Transactions to entities by plain propagation over all matched pairs. Ids are numbers in their order
    meanwhile, as pairs are many more than rows: numbers are compared and aggregated by hash, texts sorted."""
    ready = prepared(transactions, passes)
    ids = ready.table.select(F.col("txId").alias("id")).where("id is not null")
    numbers = measured(number_ids(ids)).table
    numbered = ready.table.join(numbers, F.col("txId") == F.col("id")).drop("txId", "id").withColumnRenamed("n", "txId")
    found = propagate_labels(matched_edges_direct(numbered, policy, passes))
    return Components(named_back(found.mapping, numbers, ready.rows), found.rounds)
