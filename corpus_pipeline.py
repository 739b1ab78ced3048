"""A training corpus from raw documents, stage by stage.

Every stage is written as Parquet and reread as the next one's ``docs``. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from samekin.llm.jaccard import one_of_each
from samekin.llm.mixing import mixed
from samekin.llm.packing import pack_binary
from samekin.llm.pii import without_personal_data
from samekin.llm.store import written
from samekin.llm.toxicity import train_severity, without_toxic


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go."""
    return without_toxic(docs, train_severity(docs, _labels(spark, sf_dir)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return one_of_each(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced by their kind. ``n_chars`` stays that of the raw text."""
    return without_personal_data(docs)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated so that expected tokens of each domain meet the target weights. Every
    document stays at least once, so the domain that is largest for its target tells how many tokens
    there will be. Toxic documents went before: their domain has no part in the mixture."""
    return mixed(docs, _labels(spark, sf_dir).where("toxic = 0"), epochs=None, least=1.0)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of power-of-two lengths."""
    return pack_binary(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("mixing", mix_to_targets),
    ("packing", pack),
]

# Models are fitted on the way, so SQL cannot express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
