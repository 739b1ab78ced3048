"""Reports over resolved entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sums run over decimals, so that they do not depend on the order in which rows are added.
MONEY = "decimal(30,8)"


def entity_report(transactions: DataFrame, mapping: DataFrame) -> DataFrame:
    """Total amount, transactions and distinct wallets per entity. A transaction without an
    entity does not appear."""
    return (
        transactions.select("txId", "amount", "wallet")
        .join(mapping, "txId")
        .groupBy("resolvedEntityId")
        .agg(
            F.sum(F.col("amount").cast(MONEY)).cast("double").alias("totalAmount"),
            F.count(F.lit(1)).alias("numberOfTxns"),
            F.count_distinct("wallet").alias("distinctIdsMerged"),
        )
        .select(
            "resolvedEntityId",
            "totalAmount",
            F.format_number("totalAmount", 0).alias("totalAmountFmt"),
            "numberOfTxns",
            "distinctIdsMerged",
        )
    )


def top_entities(transactions: DataFrame, mapping: DataFrame, top_n: int) -> DataFrame:
    """The entities with the largest totals; ties go by wallets, transactions, then id."""
    return (
        entity_report(transactions, mapping)
        .orderBy(
            F.desc("totalAmount"),
            F.desc("distinctIdsMerged"),
            F.desc("numberOfTxns"),
            "resolvedEntityId",
        )
        .limit(top_n)
    )


def entity_sizes(mapping: DataFrame) -> DataFrame:
    """Transactions per entity, largest first."""
    return (
        mapping.groupBy("resolvedEntityId")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "resolvedEntityId")
    )
