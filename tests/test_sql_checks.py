"""Every query with an SQL counterpart gives the same rows as DuckDB does."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def comparable(rows):
    def plain(value):
        if isinstance(value, float):
            return 0.0 if value == 0 or math.isnan(value) else value
        return value

    return sorted(repr([plain(v) for v in row]) for row in rows)


def test_every_check_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    found = entry.queries()[name](spark, SF)
    names = sorted(found.columns)
    answer = duck.execute(entry.oracle_sql()[name])
    order = [d[0] for d in answer.description]
    assert names == sorted(order)
    expected = [[row[order.index(n)] for n in names] for row in answer.fetchall()]
    assert comparable([[r[n] for n in names] for r in found.collect()]) == comparable(expected)


def test_entry(spark):
    found = entry.entry(spark).orderBy("rank").collect()
    assert found[0].id == "images_000000000001"
    assert found[0].similarity == pytest.approx(1.0)
    assert [r.rank for r in found] == list(range(1, len(found) + 1))
