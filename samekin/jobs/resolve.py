"""Resolve entities and write every stage as a table.

    python -m samekin.jobs.resolve transactions.parquet out --policy policy.json
"""

from __future__ import annotations

import argparse
import pathlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.storagelevel import StorageLevel

from samekin.operators import metrics, report
from samekin.operators.blocking import DEFAULT_PASSES, BlockingPass, block
from samekin.operators.matching import prepared
from samekin.plans.policy import DecisionPolicy
from samekin.plans.resolution import TOP_ENTITIES, decided_pairs, resolve_entities
from samekin.session import scratch_run
from samekin.sources import payments


def resolve(
    transactions: DataFrame,
    target: str,
    policy: DecisionPolicy,
    passes: tuple[BlockingPass, ...] = DEFAULT_PASSES,
    explain: bool = False,
) -> list[int]:
    """Write the block reports, the mapping, entity sizes, the top entities and the funnel under
    ``target``; with ``explain`` also a decision for every candidate pair. Returns the label
    changes per round."""

    def write(table: DataFrame, name: str) -> None:
        table.write.mode("overwrite").parquet(f"{target}/{name}")

    with scratch_run(transactions.sparkSession):
        # Read by every stage below, and the source may be CSV.
        transactions = transactions.persist(StorageLevel.MEMORY_AND_DISK)
        for blocking in passes:
            blocked = block(transactions, blocking.key())
            write(metrics.top_block_sizes(blocked), f"top_blocks_{blocking.name}")
            if blocking.max_block_size is not None:
                rate = metrics.cap_hit_rate(blocked, blocking.max_block_size)
                write(rate, f"cap_hit_rate_{blocking.name}")
        if explain:
            write(decided_pairs(transactions, policy, passes), "decisions")

        ready = prepared(transactions, passes)
        resolved = resolve_entities(ready.table, policy, passes)
        mapping = resolved.mapping
        write(mapping, "mapping")
        write(report.entity_sizes(mapping), "entity_sizes")
        write(report.top_entities(transactions, mapping, TOP_ENTITIES), "top_entities")
        write(metrics.stage_funnel(ready, mapping, policy, passes), "funnel")
        transactions.unpersist()
        return resolved.rounds


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("source", help="canonical Parquet, or a raw payment .csv")
    parser.add_argument("target", help="folder for the result tables")
    parser.add_argument("--policy", help="JSON file with the policy settings")
    parser.add_argument("--explain", action="store_true", help="also write all decisions")
    arguments = parser.parse_args()
    policy = DecisionPolicy()
    if arguments.policy:
        policy = DecisionPolicy.from_json(pathlib.Path(arguments.policy).read_text())
    spark = SparkSession.builder.appName("samekin-resolve").getOrCreate()
    if arguments.source.endswith(".csv"):
        transactions = payments.load_payments(spark, arguments.source)
    else:
        transactions = payments.read_transactions(spark, arguments.source)
    rounds = resolve(
        transactions,
        arguments.target,
        policy,
        explain=arguments.explain,
    )
    print(f"label changes per round: {rounds}")


if __name__ == "__main__":
    main()
