"""Every query against its SQL over the driver's smallest tables, and the written stages."""

import os

import pytest

import __spark_entry__ as contract
from samekin.jobs.resolve import resolve
from samekin.plans.policy import DecisionPolicy
from samekin import catalog, oracle
from tests.test_decisions import payments
from tests.oracle_check import connect, difference

SF_DIR = os.path.join(os.environ.get("TESTDATA_DIR", "/root/testdata"), "sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(oracle.oracle_sql())
    assert set(catalog.queries()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query_equals_its_sql(spark, con, name):
    found, _ = difference(
        spark, con, catalog.queries()[name], oracle.oracle_sql()[name], SF_DIR
    )
    assert found is None


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


def test_resolve_job_writes_every_stage(spark, tmp_path):
    target = str(tmp_path / "out")
    rounds = resolve(payments(spark), target, DecisionPolicy(), explain=True)
    assert rounds[-1] == 0
    assert sorted(os.listdir(target)) == [
        "decisions",
        "entity_sizes",
        "funnel",
        "mapping",
        "top_blocks_amount_type",
        "top_blocks_exact_name",
        "top_entities",
    ]
    sizes = spark.read.parquet(f"{target}/entity_sizes").orderBy("resolvedEntityId").collect()
    assert [tuple(r) for r in sizes] == [("a1", 2), ("a4", 2), ("a8", 2)]
