"""Gap sessions given period by period against one cut over all rows."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from weft.operators.incremental import SessionStore
from weft.operators.sessions import SessionSpec, cut_sessions, gap_sessions

SPEC = SessionSpec("u", "t", "o", "k", first=("v",), landing=("v",))
DAY = dt.timedelta(days=1)
START = dt.datetime(2024, 2, 27)


def log(spark, days, n, seed=1, kind="timestamp_ntz"):
    rnd = random.Random(seed)
    rows = []
    for o in range(n):
        # much around midnight, and one visitor who never pauses
        day = rnd.randrange(days)
        minutes = rnd.choice([rnd.uniform(0, 1440), rnd.uniform(-40, 40) % 1440, 0.0])
        rows.append((rnd.choice(["a", "b", "c"]), START + day * DAY + dt.timedelta(minutes=minutes), o, rnd.choice(["pageview", "click", "other"]), float(o)))
    rows += [("hot", START + dt.timedelta(minutes=29 * k), 100_000 + k, "click", 0.5) for k in range(days * 1440 // 29)]
    return spark.createDataFrame(rows, "u string, t timestamp_ntz, o long, k string, v double").withColumn("t", F.col("t").cast(kind))


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_day_by_day_equals_one_cut(spark, tmp_path, kind):
    df = log(spark, 4, 300, kind=kind).cache()
    store = SessionStore(spark, str(tmp_path / "s"), SPEC)
    for k in range(4):
        day = START + k * DAY
        got = store.advance(df, day.date().isoformat(), day, day + DAY)
        assert got.number == k + 1 and got.dropped == () and got.open >= 1
    assert rows_of(store.sessions()) == rows_of(gap_sessions(df, SPEC))
    assert store.periods() == [(START + k * DAY).date().isoformat() for k in range(4)]
    # only sessions within the gap of the end are open
    still = store.sessions().count() - store.sessions(with_open=False).count()
    assert still == got.open < 10


def test_a_day_rerun_changes_nothing_and_a_changed_day_drops_what_follows(spark, tmp_path):
    df = log(spark, 4, 200, seed=2).cache()
    store = SessionStore(spark, str(tmp_path / "s"), SPEC)
    run = lambda rows, k: store.advance(rows, f"d{k}", START + k * DAY, START + (k + 1) * DAY)
    for k in range(4):
        run(df, k)
    want = rows_of(store.sessions())
    for k in (1, 3, 0):
        assert run(df, k).dropped == ()
        assert rows_of(store.sessions()) == want and store.periods() == ["d0", "d1", "d2", "d3"]
    late = df.unionByName(spark.createDataFrame([("late", START + 2 * DAY - dt.timedelta(minutes=3), 1, "click", 1.0)], df.schema))
    assert run(late, 1).dropped == ("d2", "d3") and store.periods() == ["d0", "d1"]
    for k in (2, 3):
        run(late, k)
    assert rows_of(store.sessions()) == rows_of(gap_sessions(late, SPEC))
    assert store.outside(late, START, START + DAY).count() == late.where(F.col("t") >= F.lit(str(START + DAY)).cast("timestamp_ntz")).count()


def test_empty_days(spark, tmp_path):
    df = log(spark, 1, 20, seed=3)
    store = SessionStore(spark, str(tmp_path / "s"), SPEC)
    with pytest.raises(FileNotFoundError):
        store.sessions()
    for k in (-1, 0, 1, 2):
        store.advance(df, f"d{k + 1}", START + k * DAY, START + (k + 1) * DAY)
    assert rows_of(store.sessions(with_open=False)) == rows_of(gap_sessions(df, SPEC))


@pytest.mark.parametrize("order", ["o", None])
def test_small_gaps_in_stretches(spark, order):
    from weft.operators import sessions as ops
    rnd = random.Random(7)
    at = 0
    rows = []
    for o in range(3000):
        at += rnd.choice([100_000, 900_000, 1_000_000, 1_000_001, 5_000_000, 700_000_000])
        rows.append(("a" if o % 7 else "b", START + dt.timedelta(microseconds=at), o, rnd.choice(["pageview", "click"])))
    df = spark.createDataFrame(rows, "u string, t timestamp_ntz, o long, k string")
    spec = SessionSpec("u", "t", order, "k")
    parts = ops.gap_parts(df, spec, "1 second", coarse=16)
    got = rows_of(ops.finish_gap(parts, spec))
    want, last = {}, {}
    for u, t, o, k in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        if u not in last or t - last[u][0] > dt.timedelta(seconds=1):
            last[u] = [t, (u, t, o)]
            want[u, t, o] = [0, 0]
        last[u][0] = t
        want[last[u][1]][k == "click"] += 1
    have = sorted((r.u, r.session_start, *([r.first_order] if order else []), r.pageview_count, r.click_count) for r in ops.finish_gap(parts, spec).collect())
    assert have == sorted((u, t, *([o] if order else []), *n) for (u, t, o), n in want.items()) and len(got) == len(want)
    assert rows_of(ops.finish_gap(ops.gap_parts(df, spec, "1 second"), spec)) == got


@pytest.mark.parametrize("dense_rows", [1, 7, 10_000])
def test_page_views_with_dense_cells(spark, dense_rows):
    df = log(spark, 3, 400, seed=4)
    burst = spark.createDataFrame([("burst", START + dt.timedelta(seconds=k % 3), k, "pageview" if k % 50 == 25 else "click", 0.0) for k in range(400)], df.schema)
    df = df.unionByName(burst)
    from weft.operators.sessions import pageview_sessions
    plain = SessionSpec("u", "t", "o", "k", first=("v",), landing=("v",))
    got = rows_of(pageview_sessions(df, plain, dense_rows=dense_rows))
    assert got == rows_of(pageview_sessions(df, plain, cell="400 day")) == rows_of(pageview_sessions(df, plain, cell="1 second", dense_rows=dense_rows))
    by = {}
    for r in sorted(df.where("k in ('pageview', 'click')").collect(), key=lambda r: (r.u, r.t, r.o)):
        own = by.setdefault(r.u, [])
        if r.k == "pageview" or not own:
            own.append([r.o, 0, 0])
        own[-1][1 + (r.k == "click")] += 1
    want = sorted((u, *s) for u, own in by.items() for s in own)
    assert sorted((r.u, r.first_order, r.pageview_count, r.click_count) for r in cut_sessions(df, plain, "pageview").collect()) == want
