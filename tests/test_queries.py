"""Every catalog query with SQL against DuckDB on the smallest tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from talus import catalog

SF = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_against_sql(spark, duck, name):
    df = catalog.queries()[name](spark, str(SF))
    said = duck.execute(catalog.oracle_sql()[name])
    columns = [d[0] for d in said.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, said.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_rows(spark, name):
    assert catalog.queries()[name](spark, str(SF)).count() > 0
