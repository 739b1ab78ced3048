"""Figures about a run: block sizes, what the cap removes, rows per stage."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samekin.operators.blocking import BlockingPass, block_sizes, pass_key
from samekin.operators.matching import Prepared, matching_join, prepared, with_match_keys
from samekin.operators.sweep import count_close_pairs
from samekin.plans.policy import BEHAVIORAL, IDENTIFIER, DecisionPolicy

# Fixed value: how many blocks the size report lists.
TOP_BLOCKS = 20


def top_block_sizes(blocked: DataFrame, top_n: int = TOP_BLOCKS) -> DataFrame:
    return block_sizes(blocked).orderBy(F.desc("count"), "blockKey").limit(top_n)


def cap_hit_rate(blocked: DataFrame, max_block_size: int) -> DataFrame:
    """One row: number of blocks, how many the cap removes, and their share in percent."""
    removed = (F.col("count") > max_block_size) | F.col("blockKey").isNull()
    total, affected = F.col("totalBlocks"), F.col("affectedBlocks")
    rate = F.coalesce(F.try_divide(affected.cast("double"), total.cast("double")), F.lit(0.0))
    return (
        block_sizes(blocked)
        .agg(F.count("*").alias("totalBlocks"), F.count_if(removed).alias("affectedBlocks"))
        .select("totalBlocks", "affectedBlocks", (rate * 100.0).alias("hitRatePct"))
    )


def _shared_keys(keyed: DataFrame, passes: tuple[BlockingPass, ...]) -> DataFrame:
    """One row per transaction and non-empty set of passes it has keys in, with ``_block`` made
    of the set's number and those keys.

    ``_sign`` is the inclusion-exclusion sign of the set: pairs found by several passes are
    counted once by adding the pairs of single keys, taking off those of two shared keys, and
    so on. The number of sets depends on the passes only.
    """
    keys = [pass_key(i) for i in range(len(passes))]
    sets = [s for size in range(1, len(keys) + 1) for s in combinations(keys, size)]
    options = []
    for number, chosen in enumerate(sets):
        present = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in chosen])
        values = [F.when(F.lit(k in chosen), F.col(k)).otherwise("").alias(k) for k in keys]
        block = F.struct(F.lit(number).alias("set"), *values)
        sign = F.lit(1 if len(chosen) % 2 else -1)
        single = F.lit(passes[keys.index(chosen[0])].name if len(chosen) == 1 else None)
        option = F.struct(block.alias("block"), sign.alias("sign"), single.cast("string").alias("only"))
        options.append(F.when(present, option))
    return keyed.withColumn("_in", F.explode(F.array_compact(F.array(*options)))).withColumns(
        {"_block": F.col("_in.block"), "_sign": F.col("_in.sign"), "_only": F.col("_in.only")}
    ).drop("_in")


def _pairs_of(members: Column) -> Column:
    members = members.cast("decimal(38,0)")
    return (members * (members - 1) / 2).cast("decimal(38,0)")


def _row_count(pairs: Column) -> Column:
    return F.coalesce(F.sum(pairs), F.lit(0)).cast("long").alias("rows")


def pair_counts(keyed: DataFrame, passes: tuple[BlockingPass, ...]) -> DataFrame:
    """Candidate pairs per pass and over all passes, from block sizes alone."""
    blocks = (
        _shared_keys(keyed, passes)
        .groupBy("_block", "_sign", "_only")
        .agg(_pairs_of(F.count("*")).alias("pairs"))
    )
    stages = [
        F.struct(
            F.lit(f"pairs_{blocking.name}").alias("stage"),
            F.when(F.col("_only") == blocking.name, F.col("pairs")).alias("pairs"),
        )
        for blocking in passes
    ]
    stages.append(
        F.struct(
            F.lit("pairs_deduplicated").alias("stage"), (F.col("_sign") * F.col("pairs")).alias("pairs")
        )
    )
    counted = blocks.select(F.explode(F.array(*stages)).alias("_in")).select("_in.*")
    return counted.groupBy("stage").agg(_row_count(F.col("pairs")))


def count_matches(
    transactions: DataFrame, policy: DecisionPolicy, passes: tuple[BlockingPass, ...]
) -> DataFrame:
    """The number of distinct matched pairs over all passes, as one ``stage``, ``rows`` row.

    Rows that look the same to the policy are merged first and weigh as many as they are, so
    copies do not multiply the work. Where closeness is all it takes to match, pairs are counted by a
    sweep; where names or wallets matter, too, the merged rows are joined.
    """
    rows = _shared_keys(with_match_keys(transactions, policy, passes), passes)
    looks = ["amount", "eventTime", "typeNorm", "nameNorm", "walletNorm"]
    points = rows.groupBy("_block", "_sign", *looks).agg(
        F.min("txId").alias("txId"), F.count("*").alias("members")
    ).withColumnRenamed("_sign", "sign")
    if policy.evidence_mode == BEHAVIORAL:
        across = count_close_pairs(points, ["_block"], policy, "sign").select("pairs", "sign")
    else:
        across = matching_join(points, ["_block"], policy).select(
            (F.col("l.members") * F.col("r.members")).cast("decimal(38,0)").alias("pairs"),
            F.col("l.sign").alias("sign"),
        )
    # A merged row matches itself unless nothing passes the amount or identifier test at all.
    alike = points.where((F.col("members") > 1) & F.lit(policy.amount_relative_tolerance > 0.0))
    if policy.evidence_mode == IDENTIFIER:
        walleted = F.col("walletNorm").isNotNull() & F.lit(policy.wallet_match_enabled)
        unnamed_passes = F.lit(policy.name_similarity_threshold <= 0.0)
        alike = alike.where(F.col("nameNorm").isNotNull() | walleted | unnamed_passes)
    within = alike.select(_pairs_of(F.col("members")).alias("pairs"), "sign")
    total = across.unionByName(within).agg(_row_count(F.col("sign") * F.col("pairs")))
    return total.select(F.lit("matched_pairs").alias("stage"), "rows")


def stage_funnel(
    transactions: DataFrame | Prepared,
    mapping: DataFrame,
    policy: DecisionPolicy,
    passes: tuple[BlockingPass, ...],
) -> DataFrame:
    """Rows per stage, from transactions to entities. Pairs are counted, never listed, and
    rows with the same id are one. The transactions are counted as they are :func:`prepared`, which
    need not be done anew where entities were resolved from the same rows."""
    ready = transactions if isinstance(transactions, Prepared) else prepared(transactions, passes)
    spark = mapping.sparkSession
    resolved = mapping.agg(
        F.count("*").alias("resolved_transactions"),
        F.count_distinct("resolvedEntityId").alias("resolved_entities"),
    )
    stages = [
        spark.createDataFrame([("transactions", ready.loaded)], "stage string, rows long"),
        pair_counts(ready.table, passes),
        count_matches(ready.table, policy, passes),
        resolved.unpivot([], ["resolved_transactions", "resolved_entities"], "stage", "rows"),
    ]
    return reduce(lambda x, y: x.unionByName(y), stages)
