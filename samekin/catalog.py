"""Queries over the driver's tables, one per operator.

``events`` joined to ``customer`` is the transaction table: the customer's name is the name, the
user id the wallet, the value the amount, the event type the type and the hours since the start of
2024 the time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samekin.functions.text import normalize_name
from samekin.operators import blocking as B
from samekin.operators import decisions as D
from samekin.operators import metrics, report
from samekin.operators.blocking import pass_key
from samekin.operators.components import grow_components
from samekin.operators.linking import connecting_edges
from samekin.operators.matching import matched_edges_direct, prepared
from samekin.operators.pairs import candidate_pairs, multi_pass_pairs, union_and_deduplicate
from samekin.operators.scoring import similarity_scores, with_match_features
from samekin.operators.skew import reused
from samekin.plans.policy import IDENTIFIER, DecisionPolicy
from samekin.plans.resolution import decided_pairs, propagate_entities, resolve_entities, scored_pairs
from samekin.session import scratch_path
from samekin.sources import payments

# The cap of the queries whose feature is a cap: few blocks here have more rows.
SMALL_CAP = 3
TOP_N = 20

STANDARD = DecisionPolicy()
IDENTIFIERS = STANDARD.with_(evidence_mode=IDENTIFIER)
# A window of three days gives entities of several members, as the graph operators need.
WIDE = STANDARD.with_(max_step_distance=72)
# Loose enough that events of different kinds and days form long chains.
LOOSE = STANDARD.with_(
    max_step_distance=168, amount_relative_tolerance=0.25, require_type_match=False
)
PASSES = B.DEFAULT_PASSES
PREFIX = (B.PREFIX_PASS,)
# A cap that the caller sets.
CAPPED = (B.NAME_PASS, B.BlockingPass("amount_type", B.amount_type_key, SMALL_CAP))

HOURS = "cast(timestampdiff(HOUR, timestamp_ntz'2024-01-01 00:00:00', ts) as bigint)"


def _spread(table: DataFrame) -> DataFrame:
    """A file with fewer splits than cores would keep most cores idle; anything larger is left
    as it is."""
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores) if table.rdd.getNumPartitions() < cores else table


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["event_id", "ts", "user_id", "event_type", "value"]
    events = _spread(spark.read.parquet(f"{sf_dir}/events.parquet").select(*columns))
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_name")
    return payments.canonicalize(
        events.join(customers, F.col("user_id") == F.col("c_custkey"), "left"),
        F.col("event_id").cast("string"),
        {
            "name": "c_name",
            "wallet": F.concat(F.lit("U"), F.col("user_id").cast("string")),
            "amount": "value",
            "txType": "event_type",
            "eventTime": F.expr(HOURS),
        },
    )


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows in the raw payment layout, for the loaders."""
    tx = transactions(spark, sf_dir)
    zero = F.lit(0.0)
    return tx.select(
        F.col("eventTime").alias("step"),
        F.col("txType").alias("type"),
        "amount",
        F.col("name").alias("nameOrig"),
        zero.alias("oldbalanceOrg"),
        F.col("amount").alias("newbalanceOrig"),
        F.concat(F.lit("M"), F.col("txId")).alias("nameDest"),
        zero.alias("oldbalanceDest"),
        zero.alias("newbalanceDest"),
        F.lit(0).alias("isFraud"),
        F.lit(0).alias("isFlaggedFraud"),
    )


def hashed_tx_id(spark, sf_dir):
    raw = raw_payments(spark, sf_dir)
    return payments.canonicalize(raw, payments.content_id())


def positional_tx_id(spark, sf_dir):
    """Positional ids depend on the file splits, so only their number is compared."""
    canonical = payments.canonicalize(raw_payments(spark, sf_dir))
    return canonical.agg(
        F.count("*").alias("rows"), F.count_distinct("txId").alias("distinctIds")
    )


def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "payments.csv")
    raw_payments(spark, sf_dir).write.option("header", True).csv(path)
    loaded = payments.load_payments(spark, path)
    return loaded.select("name", "wallet", "amount", "txType", "eventTime")


def csv_rejects(spark, sf_dir):
    """A file in which every seventh payment has a broken amount: lines taken and rejected, and how many
    of either are whole, with an amount or with the text that was found in its place."""
    path = scratch_path(spark, "payments.csv")
    raw = raw_payments(spark, sf_dir)
    number = F.substring("nameDest", 2, 20).cast("long")
    broken = F.when(number % 7 == 0, F.lit("n/a")).otherwise(F.col("amount").cast("string"))
    raw.withColumn("amount", broken).write.option("header", True).csv(path)
    accepted, rejected = payments.load_payments_checked(spark, path)
    named = F.col("line").contains("n/a,") & F.col("line").contains(",M")
    kinds = accepted.select(F.lit("accepted").alias("kind"), F.col("amount").isNotNull().alias("whole"))
    kinds = kinds.unionByName(rejected.select(F.lit("rejected").alias("kind"), named.alias("whole")))
    return kinds.groupBy("kind").agg(F.count("*").alias("lines"), F.count_if("whole").alias("whole"))


def csv_strict_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "payments.csv")
    raw_payments(spark, sf_dir).write.option("header", True).csv(path)
    return payments.load_payments_strict(spark, path)


def parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "transactions.parquet")
    payments.write_transactions(transactions(spark, sf_dir), path)
    return payments.read_transactions(spark, path)


def normalized_names(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    return tx.select("txId", normalize_name(F.col("name")).alias("normalizedName"))


def _keys(key):
    def query(spark, sf_dir):
        return B.block(transactions(spark, sf_dir), key()).select("txId", "blockKey")

    return query


def _blocked(spark, sf_dir, key=B.amount_type_key):
    return B.block(transactions(spark, sf_dir), key())


def _top_blocks(key):
    return lambda spark, sf_dir: metrics.top_block_sizes(_blocked(spark, sf_dir, key), TOP_N)


def block_sizes_amount(spark, sf_dir):
    return B.block_sizes(_blocked(spark, sf_dir))


def cap_blocks(spark, sf_dir):
    return B.cap_blocks(_blocked(spark, sf_dir), SMALL_CAP).select("txId", "blockKey")


def cap_hit_rate(spark, sf_dir):
    return metrics.cap_hit_rate(_blocked(spark, sf_dir), SMALL_CAP)


def sub_block(spark, sf_dir):
    blocked = _blocked(spark, sf_dir, B.exact_name_key)
    return B.sub_block(blocked, SMALL_CAP, F.col("txType")).select("txId", "blockKey")


def _pair_rows(pairs):
    return pairs.select(
        F.col("left.txId").alias("leftTxId"), F.col("right.txId").alias("rightTxId"), "blockKey"
    )


def pairs_name(spark, sf_dir):
    return _pair_rows(candidate_pairs(_blocked(spark, sf_dir, B.exact_name_key)))


def pairs_amount(spark, sf_dir):
    return _pair_rows(candidate_pairs(_blocked(spark, sf_dir)))


def pairs_union_dedup(spark, sf_dir):
    by_name = candidate_pairs(_blocked(spark, sf_dir, B.exact_name_key))
    by_amount = candidate_pairs(_blocked(spark, sf_dir))
    return _pair_rows(union_and_deduplicate(by_name, by_amount))


def pairs_deduped(spark, sf_dir):
    pairs = multi_pass_pairs(transactions(spark, sf_dir), PASSES)
    return pairs.select(
        F.col("left.txId").alias("leftTxId"),
        F.col("right.txId").alias("rightTxId"),
        "blockKey",
        F.array_join("passes", ",").alias("passes"),
    )


def similarity_scores_all(spark, sf_dir):
    return scored_pairs(transactions(spark, sf_dir), PASSES)


def similarity_scores_amount(spark, sf_dir):
    """Names that differ, so that the edit distance is exercised."""
    rows = with_match_features(_blocked(spark, sf_dir))
    return similarity_scores(candidate_pairs(rows))


def _decisions(policy):
    def query(spark, sf_dir):
        return decided_pairs(transactions(spark, sf_dir), policy, PASSES).select(
            "leftTxId",
            "rightTxId",
            F.array_join("decisionReasons", ";").alias("reasons"),
            "decision",
            "policyVersion",
        )

    return query


def decision_summary(spark, sf_dir):
    threshold = WIDE.name_similarity_threshold
    return D.score_summary(scored_pairs(transactions(spark, sf_dir), PASSES, threshold), WIDE)


def matched_edges(spark, sf_dir):
    return D.matched_edges(decided_pairs(transactions(spark, sf_dir), WIDE, PASSES))


def _matched_direct(policy, passes):
    return lambda spark, sf_dir: matched_edges_direct(transactions(spark, sf_dir), policy, passes)


def match_count(spark, sf_dir):
    return metrics.count_matches(transactions(spark, sf_dir), WIDE, PASSES)


def content_id_edges(spark, sf_dir):
    """Matched pairs of a table in which every payment occurs twice, under content ids."""
    path = scratch_path(spark, "payments.csv")
    raw = raw_payments(spark, sf_dir)
    raw.unionByName(raw).write.option("header", True).csv(path)
    return matched_edges_direct(payments.load_payments_strict(spark, path), WIDE, PASSES)


def _entities(policy, passes):
    return lambda spark, sf_dir: resolve_entities(
        transactions(spark, sf_dir), policy, passes
    ).mapping


def components_grown(spark, sf_dir):
    """The entities of the name pass, grown by the edges of the amount pass."""
    rows = prepared(transactions(spark, sf_dir), PASSES).table
    first = resolve_entities(rows, WIDE, PASSES[:1]).mapping
    with reused() as keep:
        more = connecting_edges(rows.withColumn(pass_key(0), F.col(pass_key(1))), WIDE, PASSES[1:], keep)
        return grow_components(first, more).mapping


def _propagated(spark, sf_dir):
    return propagate_entities(transactions(spark, sf_dir), WIDE, PASSES)


def components_propagated(spark, sf_dir):
    """By plain propagation over all matched pairs, to convergence."""
    return _propagated(spark, sf_dir).mapping



def propagation_rounds(spark, sf_dir):
    """Label changes per round of plain propagation, down to the round without any."""
    rounds = _propagated(spark, sf_dir).rounds
    return spark.createDataFrame(list(enumerate(rounds, 1)), "iteration bigint, changed bigint")


def entity_sizes(spark, sf_dir):
    return report.entity_sizes(_entities(WIDE, PASSES)(spark, sf_dir))


def entity_report(spark, sf_dir):
    return report.entity_report(
        transactions(spark, sf_dir), _entities(WIDE, PASSES)(spark, sf_dir)
    )


def bucketed_entity_report(spark, sf_dir):
    """The report over transactions and mapping in buckets by id."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tx, mapping = transactions(spark, sf_dir), _entities(WIDE, PASSES)(spark, sf_dir)
    tables = [
        payments.write_bucketed(rows, f"{name}_{uuid.uuid4().hex}", scratch_path(spark, name), buckets)
        for name, rows in (("transactions", tx), ("mapping", mapping))
    ]
    return report.entity_report(*tables)


def top_entities(spark, sf_dir):
    mapping = _entities(WIDE, PASSES)(spark, sf_dir)
    return report.top_entities(transactions(spark, sf_dir), mapping, TOP_N)


def top_entities_propagated(spark, sf_dir):
    """The report over entities by plain propagation."""
    mapping = components_propagated(spark, sf_dir)
    return report.top_entities(transactions(spark, sf_dir), mapping, TOP_N)


def stage_funnel(spark, sf_dir):
    ready = prepared(transactions(spark, sf_dir), PASSES)
    mapping = resolve_entities(ready.table, WIDE, PASSES).mapping
    return metrics.stage_funnel(ready, mapping, WIDE, PASSES)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "canonical_transactions": transactions,
        "hashed_tx_id": hashed_tx_id,
        "positional_tx_id": positional_tx_id,
        "csv_roundtrip": csv_roundtrip,
        "csv_rejects": csv_rejects,
        "csv_strict_roundtrip": csv_strict_roundtrip,
        "parquet_roundtrip": parquet_roundtrip,
        "normalized_names": normalized_names,
        "prefix_block_keys": _keys(B.prefix_key),
        "block_keys_name": _keys(B.exact_name_key),
        "block_keys_amount": _keys(B.amount_type_key),
        "block_sizes_amount": block_sizes_amount,
        "top_blocks_name": _top_blocks(B.exact_name_key),
        "top_blocks_amount": _top_blocks(B.amount_type_key),
        "cap_blocks": cap_blocks,
        "cap_hit_rate": cap_hit_rate,
        "subblock": sub_block,
        "pairs_name": pairs_name,
        "pairs_amount": pairs_amount,
        "pairs_union_dedup": pairs_union_dedup,
        "pairs_deduped": pairs_deduped,
        "similarity_scores": similarity_scores_all,
        "similarity_scores_amount": similarity_scores_amount,
        "decisions_behavioral": _decisions(STANDARD),
        "decisions_identifier": _decisions(IDENTIFIERS),
        "decision_summary": decision_summary,
        "matched_edges": matched_edges,
        "matched_edges_fast": _matched_direct(WIDE, PASSES),
        "matched_edges_capped": _matched_direct(WIDE, CAPPED),
        "content_id_edges": content_id_edges,
        "matched_edges_identifier": _matched_direct(IDENTIFIERS, PASSES),
        "match_count": match_count,
        "components_converged": _entities(WIDE, PASSES),
        "components_prefix": _entities(STANDARD, PREFIX),
        "components_loose": _entities(LOOSE, PASSES),
        "components_identifier": _entities(IDENTIFIERS.with_(max_step_distance=72), PASSES),
        "components_identifier_prefix": _entities(IDENTIFIERS.with_(max_step_distance=72), PREFIX),
        "components_grown": components_grown,
        "components_propagated": components_propagated,
        "propagation_rounds": propagation_rounds,
        "entity_sizes": entity_sizes,
        "entity_report": entity_report,
        "bucketed_entity_report": bucketed_entity_report,
        "top_entities": top_entities,
        "top_entities_propagated": top_entities_propagated,
        "stage_funnel": stage_funnel,
    }
