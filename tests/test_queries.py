"""Every registered query against its SQL, over whole tables of the smallest scale."""

import os
import re

import pytest

import __spark_entry__ as entry_module
from tests.conftest import plan_of
from tools.compare import difference, open_duckdb
from workload import ORACLES, QUERIES
from workload.inputs import raw_frame

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return open_duckdb(SF_DIR)


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, con, key):
    got = entry_module.queries()[key](spark, SF_DIR).toArrow()
    want = con.execute(entry_module.oracle_sql()[key]).to_arrow_table()
    assert difference(got, want) is None


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_lines_go_to_their_order_before_they_are_counted(spark, con):
    """A task's lines are of nearly as many orders: counting them before the shuffle is in vain."""
    raw = raw_frame(spark, SF_DIR, "stg_fpl__fixtures", "1")
    plan = re.sub(r"#\d+L?", "", plan_of(raw))
    assert re.search(r"Exchange hashpartitioning\(o_orderkey, \d+\), REPARTITION_BY_COL", plan)
    lines = con.execute("SELECT l_orderkey, COUNT(*) FROM lineitem GROUP BY 1").fetchall()
    orders = {r["id"]: r["n"] for r in raw.selectExpr("id", "stats.lines AS n").collect()}
    assert orders and sum(n or 0 for n in orders.values()) == sum(n for k, n in lines if k in orders)
    assert all(orders.get(k, n) == n for k, n in lines)
