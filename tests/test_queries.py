"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if isinstance(x, float):
        return f"{x:.10g}"
    return str([plain(y) for y in x]) if isinstance(x, list) else str(x)


def rows(table):
    names = sorted(table.column_names)
    return names, sorted(tuple(map(plain, r)) for r in zip(*(table.column(c).to_pylist() for c in names), strict=True))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    want = duck.sql(entry.oracle_sql()[name]).arrow()
    want = want.read_all() if hasattr(want, "read_all") else want
    assert rows(entry.queries()[name](spark, SF).toArrow()) == rows(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
