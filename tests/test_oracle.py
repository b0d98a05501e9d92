"""Every registered query against its SQL in DuckDB, on whole tables."""

import datetime as dt
import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "DATE": "date",
}


@pytest.fixture(scope="session")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{os.path.join(sf, t)}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, sf, duck, name):
    df = queries()[name](spark, sf)
    got = df.collect()
    if name not in oracle_sql():
        assert got
        return
    result = duck.execute(oracle_sql()[name])
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    want = result.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert dict(df.dtypes) == {n: TYPES[t] for n, t in types.items()}
    keys = sorted(names)
    mine = sorted((tuple(plain(r[k]) for k in keys) for r in got), key=repr)
    theirs = sorted((tuple(plain(r[names.index(k)]) for k in keys) for r in want), key=repr)
    assert mine == theirs


def test_entry(spark):
    assert entry(spark).count() > 0
