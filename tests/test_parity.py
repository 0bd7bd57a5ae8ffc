import glob
import math
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import DATA

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def cell(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 6) + 0.0)
    if isinstance(v, Decimal):
        return repr(float(v))
    if isinstance(v, (list, tuple)):
        return [cell(x) for x in v]
    return str(v)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_gives_the_rows_of_its_sql(spark, duck, name):
    if name.startswith("p") and name[1:2].isdigit() and name not in SQL:
        pytest.skip("tested with its operator")
    df = entry.queries()[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted(str([cell(r[c]) for c in cols]) for r in df.collect())
    if name in SQL:
        out = duck.execute(SQL[name])
        names = [d[0] for d in out.description]
        assert sorted(names) == cols
        assert got == sorted(str([cell(r[names.index(c)]) for c in cols]) for r in out.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
