"""Every query that has SQL, against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from tabwright import queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="no test tables")


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    return str(value) if hasattr(value, "isoformat") else value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr), sorted(names)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_duckdb(spark, duck, name):
    got = queries.queries()[name](spark, SF)
    found, names = rows_of(got.columns, got.collect())
    want = duck.execute(queries.oracle_sql()[name])
    expected, wanted = rows_of([c[0] for c in want.description], want.fetchall())
    assert names == wanted
    assert found == expected


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(queries.oracle_sql())))
def test_runs(spark, name):
    assert queries.queries()[name](spark, SF).columns
