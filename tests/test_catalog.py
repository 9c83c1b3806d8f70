"""Every registered query against its SQL twin, over whole tables."""

import os

import pytest

import __spark_entry__ as contract
from pressmill.plans.catalog import QUERIES
from pressmill.plans.oracle import ORACLE
from compare import connect, difference

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not present")


@pytest.fixture(scope="module")
def sql():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sql, name):
    got = contract.queries()[name](spark, FOLDER).toArrow()
    want = sql.sql(contract.oracle_sql()[name]).to_arrow_table()
    assert got.num_rows > 0
    assert difference(got, want) is None


def test_every_query_has_a_twin():
    assert set(ORACLE) == set(QUERIES) and set(QUERIES) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["question_id", "answer", "sources"] and df.count() > 0


@pytest.mark.parametrize("name,python", [("hash_embedding", 1), ("chunk_documents", 1), ("embedded_output", 2), ("parse_rss", 0)])
def test_python_steps_run_once(spark, name, python):
    plan = contract.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == python
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
