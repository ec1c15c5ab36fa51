"""Every registered query against its SQL equivalent on the smallest tables."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
TABLES = "customer part orders lineitem embeddings events documents benchmark pages labels conversations"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for table in TABLES.split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


def normal(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(str(row[i]) for i in order) for row in found)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, sql, name):
    df = contract.queries()[name](spark, FOLDER)
    cursor = sql.execute(contract.oracle_sql()[name])
    expected = normal([d[0] for d in cursor.description], cursor.fetchall())
    assert normal(df.columns, [tuple(r) for r in df.collect()]) == expected


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_query_without_sql_returns_rows(spark, name):
    assert contract.queries()[name](spark, FOLDER).count() > 0


def test_every_statement_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 10


@pytest.mark.parametrize("name", ["rec_popularity", "rec_hybrid", "similar_genre", "recommend_cold", "rec_als"])
def test_no_product_in_list_plans(spark, name):
    plan = contract.queries()[name](spark, FOLDER)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_workers_need_no_copy_of_the_package(tmp_path):
    """Python workers started elsewhere cannot import the library."""
    root = os.path.dirname(os.path.abspath(contract.__file__))
    script = f"""
import sys; sys.path.insert(0, {root!r})
from ratingloom.session import build_session
import __spark_entry__ as contract
spark = build_session("other", "local[2]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"}})
assert contract.queries()["similar_dot"](spark, {FOLDER!r}).count() > 0
assert contract.queries()["similar_genre"](spark, {FOLDER!r}).count() > 0
"""
    found = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert found.returncode == 0, found.stderr[-2000:]
