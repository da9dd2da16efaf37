"""Every registered mart query against its DuckDB statement of the same semantics."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from ledgerline.plans.registry import load_all

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
RAW = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
KEYS = sorted(load_all())
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in RAW:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return v


_SPARK = {"string": "str", "int": "int32", "bigint": "int64", "double": "double", "boolean": "bool", "date": "date"}
_DUCK = {"VARCHAR": "str", "INTEGER": "int32", "BIGINT": "int64", "DOUBLE": "double", "BOOLEAN": "bool", "DATE": "date"}


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


def test_every_key_has_an_oracle():
    missing = [k for k in KEYS if k not in ORACLE]
    assert missing == []


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[key])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    stypes = {f.name: _SPARK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    dtypes = {c: _DUCK.get(str(t), str(t)) for c, t in zip(dcols, [d[1] for d in cur.description])}
    assert stypes == dtypes
    assert len(srows) == len(drows)
    assert _rows(df.columns, srows) == _rows(dcols, drows)
