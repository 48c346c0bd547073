"""Every query with SQL gives DuckDB's rows on the smallest tables."""

import math

import duckdb
import pytest

from lociweave.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return str([plain(x) for x in v]) if isinstance(v, (list, tuple)) else str(v)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_rows(spark, duck, sf_dir, name):
    df = registry.queries()[name](spark, sf_dir)
    r = duck.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in r.description]
    assert sorted(columns) == sorted(df.columns)
    keys = sorted(columns)
    want = sorted(tuple(plain(row[columns.index(k)]) for k in keys) for row in r.fetchall())
    assert sorted(tuple(plain(row[k]) for k in keys) for row in df.collect()) == want
