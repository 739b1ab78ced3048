"""Payment sources and sinks: CSV and Parquet scans, surrogate ids, the canonical row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from samekin.schema import RAW_SCHEMA, TX_SCHEMA, require_columns
from samekin.session import scratch_path

# Fields of the content hash, in order, and their separator.
HASH_FIELDS = ["step", "type", "nameOrig", "nameDest", "amount"]
HASH_SEPARATOR = "-"

# Canonical column -> raw column. Name and wallet are both the paying account.
RAW_TO_CANONICAL = {
    "name": "nameOrig",
    "wallet": "nameOrig",
    "amount": "amount",
    "txType": "type",
    "eventTime": "step",
}


def read_raw_csv(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Scan a raw payment CSV with header. ``strict`` aborts on a malformed row; otherwise
    fields that do not parse become null."""
    mode = "FAILFAST" if strict else "PERMISSIVE"
    return spark.read.schema(RAW_SCHEMA).option("header", True).option("mode", mode).csv(path)


def read_raw_csv_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Scan a raw payment CSV with header into the rows that parse and the lines that do not (column
    ``line``). Every line is in one of the two."""
    corrupt = "_line"
    schema = T.StructType([*RAW_SCHEMA.fields, T.StructField(corrupt, T.StringType())])
    reader = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
    # Parsed once, with all columns: a scan for some of them does not see faults in the others.
    parsed = scratch_path(spark, "parsed")
    reader.option("columnNameOfCorruptRecord", corrupt).csv(path).write.parquet(parsed)
    lines = spark.read.schema(schema).parquet(parsed)
    accepted = lines.where(F.col(corrupt).isNull()).select(*RAW_SCHEMA.names)
    return accepted, lines.where(F.col(corrupt).isNotNull()).select(F.col(corrupt).alias("line"))


def positional_id() -> Column:
    """Unique per row, but dependent on how the input was split into partitions."""
    return F.monotonically_increasing_id().cast("string")


def content_id(fields: list[str] | None = None) -> Column:
    """SHA-256 over the row's content. Exact duplicate rows get the same id."""
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *(fields or HASH_FIELDS)), 256)


def canonicalize(
    raw: DataFrame, tx_id: Column | None = None, columns: dict[str, str | Column] | None = None
) -> DataFrame:
    """Project raw rows to canonical transactions. ``columns`` maps canonical names to raw
    column names or expressions, so that any table can be brought into this shape."""
    mapping = columns or RAW_TO_CANONICAL
    selected = [(positional_id() if tx_id is None else tx_id).alias("txId")]
    for field in TX_SCHEMA.fields:
        if field.name != "txId":
            source = mapping[field.name]
            column = F.col(source) if isinstance(source, str) else source
            selected.append(column.cast(field.dataType).alias(field.name))
    return raw.select(*selected)


def load_payments(spark: SparkSession, path: str) -> DataFrame:
    """Permissive CSV scan with positional ids, as canonical transactions."""
    return canonicalize(read_raw_csv(spark, path))


def load_payments_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """As :func:`load_payments`, from the rows that parse; and the lines that do not."""
    accepted, rejected = read_raw_csv_checked(spark, path)
    return canonicalize(accepted), rejected


def load_payments_strict(spark: SparkSession, path: str) -> DataFrame:
    """Strict CSV scan with content ids, as canonical transactions."""
    return canonicalize(read_raw_csv(spark, path, strict=True), content_id())


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    """Scan canonical transactions from Parquet."""
    return require_columns(spark.read.parquet(path), TX_SCHEMA)


def write_transactions(transactions: DataFrame, path: str) -> None:
    """Write canonical transactions to Parquet, replacing what is there."""
    transactions.write.mode("overwrite").parquet(path)


def write_bucketed(rows: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    """Write transactions, or anything else with a ``txId``, to Parquet at ``path`` in ``buckets`` by id,
    sorted, as ``table`` of the session's catalog, and scan it. Tables of equally many buckets are joined
    by id, and grouped by it, without moving a row."""
    writer = rows.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, "txId").sortBy("txId").saveAsTable(table)
    return rows.sparkSession.table(table)
