"""All registered graph queries against DuckDB on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from axonweave import queries as Q

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def oracle():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_equals_duckdb(spark, oracle, name):
    got = entry.queries()[name](spark, SF)
    cols = sorted(got.columns)
    rows = sorted((tuple(r[c] for c in cols) for r in got.collect()), key=str)
    rel = oracle.execute(entry.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert rows == sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=str)


def test_entry(spark):
    assert entry.entry(spark).count() == 100


def test_paths_query(spark):
    rows = Q.QUERIES["j01_shortest_paths"](spark, SF).collect()
    assert rows and all(r.path.startswith(f"{r.source}>") and r.path.endswith(f">{r.target}") and r.nodes == r.path.count(">") + 1 for r in rows)
