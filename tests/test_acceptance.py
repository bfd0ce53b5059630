"""Every acceptance query against its SQL, as a multiset of rows."""

import math

import duckdb
import pytest
from conftest import TESTDATA

import __spark_entry__ as entry_points

FOLDER = f"{TESTDATA}/sf0.01"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
QUERIES, ORACLE = entry_points.queries(), entry_points.oracle_sql()


def views(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


@pytest.fixture(scope="module")
def duck():
    return views(FOLDER)


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def compare(spark, duck, folder, name):
    result = QUERIES[name](spark, folder)
    expected = duck.execute(ORACLE[name])
    columns = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(columns)
    got = rows_of(result.columns, result.collect())
    assert got == rows_of(columns, expected.fetchall())
    assert got


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    compare(spark, duck, FOLDER, name)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize(
    ("name", "pairs"), [("pair_combinations", 117_581), ("pair_permutations", 238_996)]
)
def test_times_add_up_to_the_spelled_out_pairs(spark, name, pairs):
    assert sum(r.times for r in QUERIES[name](spark, FOLDER).select("times").collect()) == pairs


def test_entry(spark):
    assert entry_points.entry(spark).count() == 20
