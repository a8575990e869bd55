"""The driver's contract: every query runs on the smallest tables and equals its SQL there."""

import math
import os
from collections import Counter
from datetime import datetime
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, Decimal):
        return float(f"{float(v):.9g}")
    if hasattr(v, "asDict"):
        v = v.asDict()
    if isinstance(v, dict):
        return tuple(sorted((str(k), plain(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v.replace(tzinfo=None).isoformat() if isinstance(v, datetime) else v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in cols) for r in df.collect())
    if name in entry.oracle_sql():
        r = con.execute(entry.oracle_sql()[name])
        names = [x[0] for x in r.description]
        assert sorted(names) == cols
        assert got == Counter(tuple(plain(x[names.index(c)]) for c in cols) for x in r.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
