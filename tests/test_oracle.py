"""Every registered query against its SQL oracle on DuckDB (sf0.001)."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from annolab.sources.testdata import TABLES
from tests.conftest import SF_SMALL

ORACLES = E.oracle_sql()


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return f"{round(v, 6):.6f}"
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(norm(r[i]) for i in order) for r in rows))
                          .encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(df.columns, srows) == digest(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "split" in df.columns


def test_every_query_has_rows_or_runs(spark):
    for name in ("ordinal_fit", "inference_compare"):
        assert E.queries()[name](spark, SF_SMALL).count() > 0
