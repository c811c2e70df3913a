"""Every registered driver query against its DuckDB oracle on sf0.001,
plus the entry() smoke check."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from fieldlake.plans import mapped, mapped_b, mapped_c, mapped_geo
from fieldlake.plans.tables import TABLES

SF = "/root/testdata/sf0.001"
SQL = E.oracle_sql()
# the corpus operators have tests of their own in tests/llm
NAMES = sorted({**mapped.QUERIES, **mapped_b.QUERIES, **mapped_geo.QUERIES, **mapped_c.QUERIES})


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "tolist"):
        return tuple(v.tolist())
    return v


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "rb_flashiness_index" in df.columns


def test_every_query_has_oracle():
    assert set(NAMES) <= set(E.queries())
    assert set(NAMES) <= set(SQL) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(SQL[name])
    orows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert len(srows) == len(orows)
    assert _canon(srows, sdf.columns) == _canon(orows, rel.columns)
