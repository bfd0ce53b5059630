"""The same queries on tables in which single keys hold a large part of the rows."""

import duckdb
import pytest
from conftest import TESTDATA
from test_acceptance import ORACLE, TABLES, compare, views

SMALL = f"{TESTDATA}/sf0.001"

# Every second line is in one basket (more than one block of rows), every third
# line has one part, every third order one customer, every second no priority.
SKEWED = {
    "lineitem": """
        SELECT * EXCLUDE (rn) REPLACE (
            CASE WHEN rn % 2 = 0 THEN 3 ELSE l_orderkey END AS l_orderkey,
            CASE WHEN rn % 3 = 1 THEN 5 ELSE l_partkey END AS l_partkey)
        FROM (SELECT *, ROW_NUMBER() OVER () AS rn FROM {source}) t
    """,
    "orders": """
        SELECT * REPLACE (
            CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey,
            CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority)
        FROM {source}
    """,
}

# Queries that read neither table are covered elsewhere.
AFFECTED = sorted(n for n, q in ORACLE.items() if "lineitem" in q or "orders" in q)


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    for name in TABLES:
        source = f"'{SMALL}/{name}.parquet'"
        query = SKEWED.get(name, "SELECT * FROM {source}").format(source=source)
        duckdb.connect().execute(f"COPY ({query}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return folder, views(folder)


def test_a_basket_is_larger_than_a_block(skewed):
    _, duck = skewed
    largest = "SELECT MAX(n) FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey)"
    assert duck.execute(largest).fetchall()[0][0] > 2000


@pytest.mark.parametrize("name", AFFECTED)
def test_matches_sql(spark, skewed, name):
    folder, duck = skewed
    compare(spark, duck, folder, name)
