"""Every registered query against its DuckDB oracle on the smallest tables,
plus the driver's smoke entry."""

from __future__ import annotations

import datetime
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from weft.plans import catalog

SF = os.environ.get("WEFT_TEST_SF", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def _key(row):
    return tuple((x is None, str(x)) for x in row)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(ocols) == cols
    idx = {c: i for i, c in enumerate(ocols)}
    want = sorted((tuple(_norm(r[idx[c]]) for c in cols) for r in cur.fetchall()), key=_key)
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:3] == ["session_id", "user_id", "session_start"]


def test_session_scan_prunes_columns_and_pushes_the_type_filter(spark):
    from weft.plans import catalog
    df = catalog._core_sessions(spark, SF, "gap")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "In(event_type" in plan
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln][0]
    assert "props" not in scan and "value" not in scan


def test_no_registered_query_caps_rows_except_the_top_k_report(spark):
    limited = set()
    for name in catalog.QUERIES:
        fn = E.queries()[name]
        plan = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
        if any(op in plan for op in ("GlobalLimit", "LocalLimit", "CollectLimit", "TakeOrderedAndProject")):
            limited.add(name)
    assert limited == {"route_top20"}
