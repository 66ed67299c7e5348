"""Every registered query of the library's own operators against its SQL in DuckDB."""

import datetime
import math
import os

import duckdb
import pytest

from quern.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, dict):
        return tuple((k, plain(x)) for k, x in v.items())
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return float(v) if v.__class__.__name__ == "Decimal" else v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.fixture(scope="session")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        c.execute(f"create view {t} as select * from '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf, duck, name):
    df = registry.QUERIES[name](spark, sf)
    got = rows(df.columns, [tuple(r.asDict(recursive=True).values()) for r in df.collect()])
    if name not in registry.ORACLES:
        return
    cur = duck.execute(registry.ORACLES[name])
    names = [d[0] for d in cur.description]
    want = rows(names, cur.fetchall())
    assert sorted(df.columns) == sorted(names)
    if got != want:
        odd = [(a, b) for a, b in zip(got, want) if a != b][:3]
        raise AssertionError(f"{len(got)} and {len(want)} rows; {odd}")
