"""Every registered query against its SQL oracle on the smallest scale factor."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from partflow.plans.catalog import REGISTRY
from partflow.plans.oracle import ORACLE
from partflow.sources.staging import TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if hasattr(v, "hour") and not (v.hour or v.minute or v.second) else v.isoformat()
    return v


def _canon(names, tuples):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_norm(t[i]) for i in order) for t in tuples]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["partNumber", "quantityText"]
    assert 0 < df.count() <= 10


def test_every_query_has_an_oracle():
    assert set(REGISTRY) == set(ORACLE)
    assert set(REGISTRY) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("key", sorted(REGISTRY))
def test_query_matches_oracle(spark, con, key):
    sdf = queries()[key](spark, SF)
    got = sdf.collect()
    sql = oracle_sql()[key]
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(sdf.columns) == sorted(names)
    assert len(got) == len(want)
    assert _canon(sdf.columns, [tuple(r) for r in got]) == _canon(names, want)
