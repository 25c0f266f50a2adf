import datetime
import decimal
import math
import os

import duckdb
import pytest

from tidemark.catalogue import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_gives_the_rows_of_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    if name not in ORACLES:
        assert rows
        return
    found = duck.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(repr([plain(r[names.index(c)]) for c in df.columns]) for r in found.fetchall())
    assert sorted(repr([plain(v) for v in r]) for r in rows) == want
