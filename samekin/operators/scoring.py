"""Similarity facts per candidate pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samekin.functions import similarity, text

# Canonical column -> (normalized column, normalization), computed once per row.
FEATURES = {
    "name": ("nameNorm", text.normalize_name),
    "wallet": ("walletNorm", text.normalize_wallet),
    "txType": ("typeNorm", text.normalize_type),
}
NAME_SKETCH = "nameSketch"
NAME_CORE = "nameCore"


def with_name_sketches(rows: DataFrame) -> DataFrame:
    """Add what tells :func:`similarity_scores` that names are far apart, once per transaction."""
    return rows.withColumn(NAME_SKETCH, similarity.name_sketch(F.col(FEATURES["name"][0])))


def with_name_cores(rows: DataFrame) -> DataFrame:
    """Add the normalized names without the letters that all of them begin and, behind these, end with, which
    :func:`similarity_scores` takes for the edit distance. The smallest and the largest of some texts begin
    in common with what all of them do."""
    name = F.col(FEATURES["name"][0])
    backward = F.reverse(name)
    ends = rows.agg(
        F.min(name).alias("low"),
        F.max(name).alias("high"),
        F.min(backward).alias("back_low"),
        F.max(backward).alias("back_high"),
        F.min(F.length(name)).alias("shortest"),
    )
    prefix = text.common_prefix(F.col("low"), F.col("high"))
    suffix = text.common_prefix(F.col("back_low"), F.col("back_high"))
    common = ends.select(prefix.alias("prefix"), F.least(suffix, F.col("shortest") - prefix).alias("suffix")).first()
    before, behind = common["prefix"] or 0, common["suffix"] or 0
    core = F.substring(name, F.lit(before + 1), F.length(name) - F.lit(before + behind))
    return rows.withColumn(NAME_CORE, core)


def with_match_features(transactions: DataFrame) -> DataFrame:
    """Add the normalized columns that scoring compares, so that normalization runs once per
    transaction and not once per pair."""
    return transactions.withColumns(
        {feature: normalize(F.col(c)) for c, (feature, normalize) in FEATURES.items()}
    )


def facts(
    left: str, right: str, ready: bool = True, least_name: float | None = None, cores: bool = False
) -> dict[str, Column]:
    """The five facts of a pair whose sides are reached as ``left.*`` and ``right.*``. If the
    normalized columns are not ``ready`` they are derived here. ``cores`` says that both sides have
    :func:`with_name_cores`. With ``least_name``, for which both
    sides need :func:`with_name_sketches`, a smaller similarity of names is told as
    something smaller."""

    def normalized(side: str, column: str) -> Column:
        feature, normalize = FEATURES[column]
        return F.col(f"{side}.{feature}") if ready else normalize(F.col(f"{side}.{column}"))

    def both(column: str) -> list[Column]:
        return [normalized(left, column), normalized(right, column)]

    def raw(column: str) -> list[Column]:
        return [F.col(f"{left}.{column}"), F.col(f"{right}.{column}")]

    if least_name is None:
        shortened = [F.col(f"{side}.{NAME_CORE}") for side in (left, right)] if cores else []
        names = similarity.name_similarity(*both("name"), *shortened)
    else:
        sketches = [F.col(f"{side}.{NAME_SKETCH}") for side in (left, right)]
        names = similarity.name_similarity_from(least_name, *both("name"), *sketches)
    return {
        "nameSimilarity": names,
        "walletExactMatch": similarity.equal_values(*both("wallet")),
        "amountRelativeDifference": similarity.amount_relative_difference(*raw("amount")),
        "typeExactMatch": similarity.equal_values(*both("txType")),
        "timeDistance": similarity.time_distance(*raw("eventTime")),
    }


def similarity_scores(pairs: DataFrame, least_name: float | None = None) -> DataFrame:
    """One row of facts per candidate pair, keeping the block key. With ``least_name`` the rows need
    :func:`with_name_sketches`, and a similarity of names below it is told as something below."""
    sides = pairs.schema["left"].dataType.names
    ready = all(f in sides for f, _ in FEATURES.values())
    columns = facts("left", "right", ready, least_name, NAME_CORE in sides)
    return pairs.select(
        F.col("left.txId").alias("leftTxId"),
        F.col("right.txId").alias("rightTxId"),
        columns["nameSimilarity"].alias("nameSimilarity"),
        columns["walletExactMatch"].alias("walletExactMatch"),
        columns["amountRelativeDifference"].alias("amountRelativeDifference"),
        "blockKey",
        columns["typeExactMatch"].alias("typeExactMatch"),
        columns["timeDistance"].alias("timeDistance"),
    )
