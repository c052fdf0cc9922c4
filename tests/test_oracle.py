"""Every query with a SQL counterpart agrees with DuckDB, row for row."""

import re
from collections import Counter

import duckdb
import pytest
from helpers import norm

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
QUERIES, STATEMENTS = entry.queries(), entry.oracle_sql()
ROWS_ONLY = ["forecaster_metrics", "forecast_sales", "train_promotion_impact", "optimize_markdown"]


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def test_registry_is_complete():
    # The operators that can be left out, and their tests, say themselves what has SQL.
    own = {q for q in QUERIES if q != "pipeline" and not re.match(r"op\d+_", q)}
    assert own - set(STATEMENTS) == set(ROWS_ONLY)
    assert set(STATEMENTS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = Counter(tuple(norm(r[c]) for c in columns) for r in df.collect())
    cursor = duck.execute(STATEMENTS[name])
    found = [c[0] for c in cursor.description]
    assert sorted(found) == columns
    places = [found.index(c) for c in columns]
    expected = Counter(tuple(norm(r[i]) for i in places) for r in cursor.fetchall())
    assert got == expected
    assert sum(got.values()) > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 84
