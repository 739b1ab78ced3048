"""Convert a raw payment CSV to canonical transactions in Parquet.

    python -m samekin.jobs.convert payments.csv transactions.parquet
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from samekin.sources import payments


def convert(spark: SparkSession, source: str, target: str, strict: bool = False) -> None:
    """One map-only job; nothing is shuffled."""
    load = payments.load_payments_strict if strict else payments.load_payments
    payments.write_transactions(load(spark, source), target)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("source")
    parser.add_argument("target")
    parser.add_argument("--strict", action="store_true", help="abort on a malformed row")
    arguments = parser.parse_args()
    spark = SparkSession.builder.appName("samekin-convert").getOrCreate()
    convert(spark, arguments.source, arguments.target, arguments.strict)


if __name__ == "__main__":
    main()
