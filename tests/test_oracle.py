"""Every registered query against its DuckDB twin on the smallest scale factor."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, norm

from tests.conftest import SF_SMALL

KEYS = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    llm = E._llm()
    stated = llm.NO_SQL if llm else {}        # what SQL cannot state, and what tests it instead
    missing = set(E.queries()) - set(E.oracle_sql())
    assert missing == set(stated) and all(stated.values()), missing ^ set(stated)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    cur = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    si = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    oi = sorted(range(len(ocols)), key=lambda i: ocols[i])
    got = sorted((tuple(norm(r[i]) for i in si) for r in df.collect()), key=repr)
    exp = sorted((tuple(norm(r[i]) for i in oi) for r in cur.fetchall()), key=repr)
    assert got == exp


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 1 and df.columns == ["c_mktsegment", "orders", "revenue"]
