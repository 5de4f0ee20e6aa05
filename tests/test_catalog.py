"""Every query of the catalogue against its SQL twin in DuckDB, on the smallest tables."""

import datetime
import decimal
import math

import duckdb
import pytest

from tidemark.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float, decimal.Decimal)):
        return f"{float(v):.6g}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(name, spark, sf_dir, duck):
    own = catalog.queries()[name](spark, sf_dir)
    rows = own.collect()
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    twin = duck.execute(sql)
    names = [c[0] for c in twin.description]
    assert sorted(names) == sorted(own.columns)
    want = sorted([plain(r[names.index(c)]) for c in own.columns] for r in twin.fetchall())
    assert sorted([plain(v) for v in r] for r in rows) == want
