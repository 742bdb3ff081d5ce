"""Every catalogue query against its SQL on the smallest tables."""

import math

import duckdb
import pytest

from recordloom.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return round(float(v), 6)
    return v


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_matches_sql(spark, sf_dir, duck, name):
    want = duck.execute(catalog.ORACLES[name])
    columns = [d[0] for d in want.description]
    want = sorted((tuple(map(plain, r)) for r in want.fetchall()), key=repr)
    df = catalog.QUERIES[name](spark, sf_dir)
    assert sorted(df.columns) == sorted(columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(*columns).collect()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_runs(spark, sf_dir, name):
    assert catalog.QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["case_id", "event_count", "first_source_index", "last_source_index"]
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", ["event_projection_cases", "historical_merge", "verified_cursor", "completeness_channels"])
def test_partitioning_does_not_matter(spark, sf_dir, name, monkeypatch):
    want = sorted(map(str, catalog.QUERIES[name](spark, sf_dir).collect()))
    read = catalog.table
    monkeypatch.setattr(catalog, "table", lambda s, d, n: read(s, d, n).repartition(7))
    assert sorted(map(str, catalog.QUERIES[name](spark, sf_dir).collect())) == want
