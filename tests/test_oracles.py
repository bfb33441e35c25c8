"""Every registered query against its SQL text on the given tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = Path("/root/testdata/sf0.01")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="given tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    yield connection
    connection.close()


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda at: columns[at])
    return sorted([tuple(row[at] for at in order) for row in rows], key=repr)


def same(left, right):
    if isinstance(left, float) and isinstance(right, float):
        return math.isclose(left, right, rel_tol=1e-12, abs_tol=1e-12)
    return type(left) is type(right) and left == right


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_matches_sql(spark, duck, name):
    result = contract.queries()[name](spark, str(SF_DIR))
    expected = duck.execute(contract.oracle_sql()[name])
    expected_columns = [column[0] for column in expected.description]
    assert sorted(result.columns) == sorted(expected_columns)
    ours = canonical(result.collect(), result.columns)
    theirs = canonical(expected.fetchall(), expected_columns)
    assert len(ours) == len(theirs) > 0
    for mine, other in zip(ours, theirs):
        assert all(map(same, mine, other)), (mine, other)


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_runs_without_sql(spark, name):
    assert contract.queries()[name](spark, str(SF_DIR)).count() > 0


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
