"""Every registered query against its SQL on DuckDB, at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from bindings.domain import TABLES, Domain
from bindings.queries import ORACLES, QUERIES
from check import rows_of

FOLDER = entry_module.SMOKE_FOLDER


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLES) <= set(entry_module.oracle_sql())


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["category", "vintage", "n_rows"] and df.count() == 8


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = entry_module.queries()[name](spark, FOLDER)
    got = rows_of(df.columns, df.collect())
    cursor = db.execute(entry_module.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == rows_of(columns, cursor.fetchall())


def test_address_points_east_of_greenwich(spark, tmp_path):
    """From 39,602 tracts on the derived grid reaches over Greenwich; longitudes there have no minus sign."""
    home = ["id AS c_custkey", "'BUILDING' AS c_mktsegment", "3 AS c_nationkey"]
    spark.range(1, 3000).selectExpr(*home).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(40401).selectExpr("id AS s_suppkey").write.parquet(f"{tmp_path}/supplier.parquet")
    spread = 201 * 5000 + 2500
    got = {r.point_id: r.longitude for r in Domain(spark, str(tmp_path))["address_points"].collect()}
    want = {k: (k * 5303 % spread - 10**6) / 10**4 for k in range(1, 3000)}
    assert {k: got[k] for k in want} == want and {k: got[-k] for k in want if k % 3 == 0} == {k: want[k] for k in want if k % 3 == 0}
    assert any(v > 0 for v in want.values())


def test_homes_are_not_sent_around_for_address_rows(spark, tmp_path):
    """Customers' files are a small part of what their streets, cities and places take in memory."""
    columns = ["id AS c_custkey", "'BUILDING' AS c_mktsegment", "3 AS c_nationkey"]
    spark.range(20).selectExpr(*columns).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(9).selectExpr("id AS s_suppkey").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(70).selectExpr("id AS o_orderkey", "id % 25 AS o_custkey").write.parquet(f"{tmp_path}/orders.parquet")
    rows = Domain(spark, str(tmp_path))["address_multi"]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert rows.count() == sum(i % 25 < 20 for i in range(70))
