"""Every registered query of the library against its SQL."""

import duckdb
import pytest

from sitegraph import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, duck, name):
    got = registry.QUERIES[name](spark, sf_dir)
    cols = sorted(got.columns)
    want = duck.sql(registry.ORACLE_SQL[name])
    assert sorted(want.columns) == cols
    rows = want.project(", ".join(f'"{c}"' for c in cols)).fetchall()
    assert sorted(map(str, map(tuple, got.select(cols).collect()))) == sorted(map(str, rows))


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_query_without_sql_runs(spark, sf_dir, name):
    assert registry.QUERIES[name](spark, sf_dir).count() > 0
