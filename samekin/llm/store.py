"""Intermediate tables of the operators, written to the cluster's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from samekin.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the folder of ``spark.checkpoint.dir``, reread. Cuts the
    lineage; a lost executor costs nothing that was written."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, column: str, buckets: int) -> DataFrame:
    """As :func:`written`, in ``buckets`` by ``column``: a join or grouping by it moves the other side
    only. The session's catalog has an entry for the table, which says how it is cut."""
    entry = f"{name}_{uuid.uuid4().hex}"
    path = scratch_path(df.sparkSession, name)
    df.write.bucketBy(buckets, column).option("path", path).format("parquet").saveAsTable(entry)
    return df.sparkSession.table(entry)


def set_aside(docs: DataFrame, names: set[str]) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the columns that are called like one of ``names`` (in any case) renamed, so that an
    operator may use these; and the new names with the old ones, to rename them back."""
    clashing = {c: f"_aside_{uuid.uuid4().hex}" for c in docs.columns if c.lower() in names}
    return docs.withColumnsRenamed(clashing), {new: old for old, new in clashing.items()}
