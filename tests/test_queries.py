"""Every registered query against its SQL on the smallest test data, and its plan."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from wakeline.plans import catalog
from tools.check import SAME, bag

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.QUERIES, catalog.SQL
#: Read only the days they ask for.
PRUNED = ("s3_day_partition_read", "p4_minute_snapshot", "p5_hour_snapshot", "p12_near_place_and_time")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(SF_DIR + "/*.parquet"):
        connection.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL) and len(QUERIES) > 100
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


def test_inventory_is_covered():
    ids = {name.split("_")[0] for name in QUERIES}
    wanted = [f"{kind}{i}" for kind, last in
              (("s", 12), ("p", 20), ("j", 9), ("a", 10), ("w", 5), ("o", 8), ("u", 2), ("f", 24), ("t", 8), ("st", 2), ("x", 3))
              for i in range(1, last + 1)]
    assert [i for i in wanted if i not in ids] == []


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert rows and any(r.centre_mmsi == r.mmsi and r.miles == 0 for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF_DIR)
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    for word in ("PythonUDF", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan
    if name in PRUNED:
        assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    want = db.sql(SQL[name])
    assert {f.name: SAME[f.dataType.simpleString()] for f in df.schema} == dict(zip(want.columns, map(str, want.types)))
    assert bag(df.columns, rows) == bag(want.columns, want.fetchall())
