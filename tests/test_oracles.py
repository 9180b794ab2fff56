"""Every registered query of the library against its SQL on the driver's smallest tables."""

import duckdb
import pytest

from weavegraph.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    c.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.sql(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return c


def plain(value):
    if isinstance(value, float):
        return float(f"{value:.10g}")
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return float(value) if hasattr(value, "as_tuple") else value


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, con, sf_dir, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    got = sorted((tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=repr)
    found = con.sql(catalog.ORACLE_SQL[name])
    order = [found.columns.index(c) for c in sorted(found.columns)]
    assert sorted(df.columns) == sorted(found.columns)
    assert got == sorted((tuple(plain(r[i]) for i in order) for r in found.fetchall()), key=repr)


def test_every_query_has_its_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLE_SQL) and catalog.FLAGSHIP in catalog.QUERIES
