"""Every core query against its SQL on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as entry
from docloom import queries as core

NAMES = sorted(core.queries())


@pytest.fixture(scope="module")
def duck(sf):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{sf}/{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return float(v) if hasattr(v, "quantize") else v


def ordered(rows):
    return sorted((tuple(map(plain, r)) for r in rows), key=lambda r: [(x is None, str(x)) for x in r])


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sf, duck, name):
    df = core.queries()[name](spark, sf)
    cols = sorted(df.columns)
    rows = [[r[c] for c in cols] for r in df.collect()]
    sql = core.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    cur = duck.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    assert ordered(rows) == ordered([[r[names.index(c)] for c in cols] for r in cur.fetchall()])


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())
