"""Queries of the training-data operators against their SQL."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

from harborline.llm import queries
from tests.conftest import SF_SMALL

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_SMALL}/{name}.parquet'")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_rows_as_sql(spark, duck, name):
    df = queries.queries()[name](spark, SF_SMALL)
    columns = sorted(df.columns)
    actual = Counter(tuple(repr(row[c]) for c in columns) for row in df.collect())
    cursor = duck.execute(queries.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert actual == Counter(tuple(repr(row[i]) for i in places) for row in cursor.fetchall())
