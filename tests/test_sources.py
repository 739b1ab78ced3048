import hashlib
import os

import pytest
from pyspark.sql import functions as F

from samekin.jobs.convert import convert
from samekin.schema import RAW_SCHEMA, TX_SCHEMA, require_columns
from samekin.operators.report import entity_report
from samekin.session import checkpoint_dir, scratch_path, scratch_run
from samekin.sources import payments

HEADER = ",".join(RAW_SCHEMA.names)
ROW = "3,PAYMENT,12.5,C1,0.0,0.0,M1,0.0,0.0,0,0"


@pytest.fixture
def csv(tmp_path):
    def write(*rows):
        path = tmp_path / "payments.csv"
        path.write_text("\n".join([HEADER, *rows]) + "\n")
        return str(path)

    return write


def test_permissive_scan_reads_bad_fields_as_null(spark, csv):
    path = csv(ROW, ROW.replace("12.5", "twelve"))
    rows = payments.read_raw_csv(spark, path).select("step", "amount").collect()
    assert [tuple(r) for r in rows] == [(3, 12.5), (3, None)]


def test_strict_scan_aborts_on_bad_fields(spark, csv):
    path = csv(ROW, ROW.replace("12.5", "twelve"))
    with pytest.raises(Exception, match="(?i)malformed"):
        payments.load_payments_strict(spark, path).collect()


def test_content_ids_repeat_for_equal_rows(spark, csv):
    rows = payments.load_payments_strict(spark, csv(ROW, ROW)).collect()
    expected = hashlib.sha256(b"3-PAYMENT-C1-M1-12.5").hexdigest()
    assert [r["txId"] for r in rows] == [expected, expected]
    assert tuple(rows[0])[1:] == ("C1", "C1", 12.5, "PAYMENT", 3)


def test_positional_ids_are_unique(spark, csv):
    table = payments.load_payments(spark, csv(*[ROW] * 50))
    assert table.schema == TX_SCHEMA or table.select(*TX_SCHEMA.names).count() == 50
    assert table.select("txId").distinct().count() == 50


def test_convert_writes_what_the_loader_reads(spark, csv, tmp_path):
    source, target = csv(ROW, ROW.replace("C1", "C2")), str(tmp_path / "out.parquet")
    convert(spark, source, target)
    convert(spark, source, target)
    written = payments.read_transactions(spark, target)
    assert sorted(map(tuple, written.collect())) == sorted(
        map(tuple, payments.load_payments(spark, source).collect())
    )


def test_require_columns_names_the_problem(spark):
    with pytest.raises(TypeError, match="amount: expected double, found string"):
        require_columns(
            spark.createDataFrame([("a", "b", "c", "d")], "txId string, name string, wallet string, amount string"),
            TX_SCHEMA,
        )


def test_checkpoint_dir_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert configured in checkpoint_dir(spark)
    assert scratch_path(spark, "x").startswith(checkpoint_dir(spark))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_checked_scan_keeps_every_line(spark, csv):
    bad = [ROW.replace("12.5", "twelve"), "only,three,fields", ROW + ",more", "x" * 9]
    accepted, rejected = payments.load_payments_checked(spark, csv(ROW, *bad, ROW))
    assert [r["amount"] for r in accepted.collect()] == [12.5, 12.5]
    assert accepted.columns == TX_SCHEMA.names
    assert sorted(r["line"] for r in rejected.collect()) == sorted(bad)
    assert accepted.count() + rejected.count() == 6
    accepted, rejected = payments.load_payments_checked(spark, csv())
    assert accepted.count() == rejected.count() == 0


def test_bucketed_tables_join_and_group_in_place(spark, tmp_path):
    rows = [(str(i), "Ann", f"w{i % 3}", float(i), "A", i) for i in range(50)]
    tx = spark.createDataFrame(rows, TX_SCHEMA)
    mapping = tx.select("txId", F.lit("0").alias("resolvedEntityId")).where("eventTime % 2 = 0")
    tables = [
        payments.write_bucketed(df, f"bucketed_{name}", str(tmp_path / name), 3)
        for name, df in (("tx", tx), ("mapping", mapping))
    ]
    joined = tables[0].hint("merge").join(tables[1], "txId")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 25
    report = entity_report(*tables).collect()
    assert [tuple(r)[1:] for r in report] == [(600.0, "600", 25, 3)]
    grouped = tables[0].groupBy("txId").count()
    assert "Exchange" not in grouped._jdf.queryExecution().executedPlan().toString()
    for name in ("tx", "mapping"):
        spark.sql(f"drop table bucketed_{name}")


def test_a_run_leaves_no_scratch_tables(spark):
    inside = []
    with scratch_run(spark):
        for name in ("a", "b"):
            inside.append(scratch_path(spark, name))
            spark.range(3).write.parquet(inside[-1])
        with scratch_run(spark):
            spark.range(3).write.parquet(scratch_path(spark, "c"))
    outside = scratch_path(spark, "d")
    spark.range(3).write.parquet(outside)
    folders = lambda paths: [os.path.dirname(p.removeprefix("file:")) for p in paths]
    assert not any(map(os.path.exists, folders(inside)))
    assert all(map(os.path.exists, folders([outside])))
