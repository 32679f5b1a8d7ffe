"""Driver contract: every registered query equals its DuckDB oracle (sf0.001)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from labelqa.plans import driver_queries as dq
from labelqa.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


def rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in records), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == entry.entry(spark).columns


def test_every_query_has_an_oracle():
    assert set(dq.QUERIES) == set(dq.ORACLE)
    assert set(dq.QUERIES) <= set(entry.queries()) and set(dq.ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(dq.ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cols, got = df.columns, [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(dcols)
    assert rows(cols, got) == rows(dcols, res.fetchall())


def test_apply_extractor_rows(spark):
    df = entry.queries()["apply_extractor"](spark, SF)
    r = df.collect()
    docs = entry.queries()["request_text"](spark, SF).count()
    assert len(r) == docs
    assert all((x.result is None) != (x.error is None) for x in r)
