"""Every registered query: its plan, and its result against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from entries import QUERIES
from entries.shapes import _WEIGHTED
from tools.check import TABLES, canonical
from urbanweave.functions.similarity import weighted_ratio

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def db():
    link = duckdb.connect()
    for table in TABLES:
        link.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return link


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, db, key):
    frame = contract.queries()[key](spark, FOLDER)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    got = frame.toPandas()
    want = db.execute(contract.oracle_sql()[key]).df()
    assert len(got) and sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_weighted_sql_on_odd_names():
    names = ["gracia", "carrer gran de gracia", "gracia gran  de carrer", "de de", "e", "plaça nova", "gran gran carrer", "carrer de la gracia e", " ", "a b", "old bolt", "bolt old"]
    db = duckdb.connect()
    db.execute("create table part as select unnest(?) as p_name", [names])
    scores = db.execute(f"{_WEIGHTED} select a, b, score from scores").fetchall()
    want = {(a, b): weighted_ratio(a, b) for name in names for a in (name.replace("e", ""), name + "s", name[::-1], name) if a for b in names}
    assert {(a, b): score for a, b, score in scores} == pytest.approx(want, abs=1e-9)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
