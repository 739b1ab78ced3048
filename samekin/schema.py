"""Table schemas. They are fixed and never inferred from the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Column names and types of the raw payment CSV.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("step", T.LongType()),
        T.StructField("type", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("nameOrig", T.StringType()),
        T.StructField("oldbalanceOrg", T.DoubleType()),
        T.StructField("newbalanceOrig", T.DoubleType()),
        T.StructField("nameDest", T.StringType()),
        T.StructField("oldbalanceDest", T.DoubleType()),
        T.StructField("newbalanceDest", T.DoubleType()),
        T.StructField("isFraud", T.IntegerType()),
        T.StructField("isFlaggedFraud", T.IntegerType()),
    ]
)

# The canonical transaction every operator works on.
TX_SCHEMA = T.StructType(
    [
        T.StructField("txId", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("wallet", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("txType", T.StringType()),
        T.StructField("eventTime", T.LongType()),
    ]
)

TX_COLUMNS = TX_SCHEMA.names


def require_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Return ``df`` if it has every field of ``schema`` with that type, else raise."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    for field in schema.fields:
        if actual.get(field.name) != field.dataType:
            raise TypeError(
                f"column {field.name}: expected {field.dataType.simpleString()}, "
                f"found {actual[field.name].simpleString() if field.name in actual else 'none'}"
            )
    return df
