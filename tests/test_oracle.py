"""Registered queries against their DuckDB oracle on the smallest tables."""

from __future__ import annotations

import hashlib
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from retentio.plans.oracle import SQL
from tests.conftest import SF0001

# every id that has SQL; the model ids are checked by bounds in test_io_learn.py
CHECKED = [k for k in SQL if k in queries()]


def _norm(v):
    if isinstance(v, float):
        return repr(v + 0.0)
    if hasattr(v, "item"):
        return _norm(v.item())
    return repr(v)


def _digest(rows):
    h = hashlib.sha256()
    for r in sorted("|".join(_norm(x) for x in row) for row in rows):
        h.update(r.encode())
    return h.hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("customer", "orders", "lineitem"):
        c.execute(f"create view {t} as select * from read_parquet('{os.path.join(SF0001, t + '.parquet')}')")
    return c


def test_every_sql_key_is_registered():
    assert set(oracle_sql()) <= set(queries())
    assert len(oracle_sql()) >= 80


def test_entry_runs(spark):
    df = entry(spark)
    rows = df.collect()
    assert df.columns == ["Recommended_Action", "Members", "Net_ROI_Sum"]
    assert sum(r.Members for r in rows) == 150


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_oracle(spark, con, name):
    sdf = queries()[name](spark, SF0001)
    cols = sorted(sdf.columns)
    srows = [tuple(r[c] for c in cols) for r in sdf.collect()]
    res = con.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    order = sorted(range(len(ocols)), key=lambda i: ocols[i])
    orows = [tuple(r[i] for i in order) for r in res.fetchall()]
    assert cols == sorted(ocols)
    assert len(srows) == len(orows)
    assert _digest(srows) == _digest(orows)
