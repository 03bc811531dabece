"""Session cutting: golden sample, boundaries, and a brute-force property test."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import COOKIE_LABELS, VISIT_LOG, write_lines
from weft import schemas
from weft.operators.sessions import SessionSpec, cut_sessions, gap_micros
from weft.plans.visits import build_sessions, clean_log, run_visit_job
from weft.sinks.writers import read_text_records
from weft.sources.formats import parse_cookie_labels

# Derived from the rules by hand.
GOLDEN_GAP = {
    ("2024-03-05 08:05:00", "v-bob", "night owl", "10.1.0.8", "http://www.ali.com/deals", 3, 1, "www.ali.com", "level2"),
    ("2024-03-05 08:00:00", "v-ann", "regular", "10.1.0.7", "https://jd.com/a", 1, 2, "jd.com", "level3"),
    ("2024-03-05 09:30:00", "v-ann", "regular", "10.1.0.9", "https://shop.example.org/x", 1, 2, "shop.example.org", "-"),
}

GOLDEN_PAGEVIEW = {
    ("v-ann", "2024-03-05 08:00:00", "https://jd.com/a", 1, 2),
    ("v-ann", "2024-03-05 09:30:00", "https://shop.example.org/x", 1, 2),
    ("v-bob", "2024-03-05 08:05:00", "http://www.ali.com/deals", 1, 0),
    ("v-bob", "2024-03-05 08:06:00", "https://blog.example.net/p1", 1, 1),
    ("v-bob", "2024-03-05 08:07:00", "https://youku.com/v", 1, 0),
}

COLS = ["session_server_time", "cookie", "cookie_label", "ip", "landing_url", "pageview_count",
        "click_count", "domain", "domain_label"]


def _sessions(spark, lines, labels=COOKIE_LABELS, strategy="gap"):
    log = clean_log(spark.createDataFrame([(x,) for x in lines], "value string")).rows
    lab = parse_cookie_labels(spark.createDataFrame([(x,) for x in labels], "value string")).rows
    return build_sessions(log, lab, strategy=strategy)


def test_golden_gap_sessions_end_to_end(spark, tmp_path):
    log = write_lines(tmp_path / "visit_log.txt", VISIT_LOG)
    lab = write_lines(tmp_path / "cookie_label.txt", COOKIE_LABELS)
    out = str(tmp_path / "out")
    counts = run_visit_job(spark, log, lab, out, sink="Text")
    assert counts["log_rows"] == 10 and counts["session_count"] == 3 and counts["reject_count"] == 0
    sessions = read_text_records(spark, f"{out}/trackerSession", schemas.TRACKER_SESSION)
    got = {tuple(r[c] for c in COLS) for r in sessions.collect()}
    assert got == GOLDEN_GAP
    assert all(len(r.session_id) == 64 for r in sessions.collect())
    logs = read_text_records(spark, f"{out}/trackerLog", schemas.TRACKER_LOG)
    assert logs.count() == 10
    assert {r.log_type for r in logs.collect()} == {"pageview", "click"}
    # text lines are (null,{...json...})
    first = spark.read.text(f"{out}/trackerSession").first().value
    assert first.startswith("(null,{") and first.endswith("})")


def test_golden_parquet_sink(spark, tmp_path):
    log = write_lines(tmp_path / "visit_log.txt", VISIT_LOG)
    lab = write_lines(tmp_path / "cookie_label.txt", COOKIE_LABELS)
    out = str(tmp_path / "out")
    run_visit_job(spark, log, lab, out, sink="parquet")
    got = {tuple(r[c] for c in COLS) for r in spark.read.parquet(f"{out}/trackerSession").collect()}
    assert got == GOLDEN_GAP
    assert spark.read.parquet(f"{out}/trackerLog").count() == 10


def test_golden_pageview_sessions(spark):
    s = _sessions(spark, VISIT_LOG, strategy="pageview")
    got = {(r.cookie, r.session_server_time, r.landing_url, r.pageview_count, r.click_count)
           for r in s.collect()}
    assert got == GOLDEN_PAGEVIEW


def _log(rows):
    return ["#h"] + ["|".join(r) for r in rows]


def test_gap_is_strict_and_compares_with_previous_row(spark):
    rows = [("pageview", "2017-01-01 10:00:00", "u", "ip1", "http://a.com/"),
            ("click", "2017-01-01 10:30:00", "u", "ip2", "http://a.com/"),   # exactly 30:00 -> same
            ("click", "2017-01-01 11:00:00", "u", "ip3", "http://a.com/"),   # 30:00 after previous row
            ("click", "2017-01-01 11:30:01", "u", "ip4", "http://a.com/")]   # 30:01 -> new session
    s = _sessions(spark, _log(rows)).collect()
    assert sorted((r.session_server_time, r.pageview_count, r.click_count) for r in s) == [
        ("2017-01-01 10:00:00", 1, 2), ("2017-01-01 11:30:01", 0, 1)]


def test_clicks_only_session_has_defaults(spark):
    rows = [("click", "2017-01-01 10:00:00", "u", "ip", "http://a.com/")]
    (r,) = _sessions(spark, _log(rows), labels=[]).collect()
    assert (r.landing_url, r.domain, r.domain_label, r.cookie_label) == ("-", "-", "-", "-")
    assert (r.pageview_count, r.click_count) == (0, 1)


def test_ties_broken_by_file_order(spark):
    rows = [("click", "2017-01-01 10:00:00", "u", "first", "http://a.com/"),
            ("pageview", "2017-01-01 10:00:00", "u", "second", "http://b.com/"),
            ("pageview", "2017-01-01 10:00:00", "u", "third", "http://c.com/")]
    (r,) = _sessions(spark, _log(rows)).collect()
    assert (r.ip, r.landing_url) == ("first", "http://b.com/")


def test_leading_clicks_under_pageview_strategy(spark):
    rows = [("click", "2017-01-01 10:00:00", "u", "ip", "http://a.com/"),
            ("click", "2017-01-01 10:00:01", "u", "ip", "http://a.com/"),
            ("pageview", "2017-01-01 10:00:02", "u", "ip", "http://b.com/"),
            ("click", "2017-01-01 10:00:03", "u", "ip", "http://b.com/")]
    s = _sessions(spark, _log(rows), strategy="pageview").collect()
    assert sorted((r.landing_url, r.pageview_count, r.click_count) for r in s) == [
        ("-", 0, 2), ("http://b.com/", 1, 1)]


def test_unknown_type_does_not_bridge_a_gap(spark):
    rows = [("pageview", "2017-01-01 10:00:00", "u", "ip", "http://a.com/"),
            ("scroll", "2017-01-01 10:20:00", "u", "ip", "http://a.com/"),
            ("pageview", "2017-01-01 10:40:00", "u", "ip", "http://a.com/")]
    assert _sessions(spark, _log(rows)).count() == 2


def test_label_fanout_and_absent_label(spark):
    rows = [("pageview", "2017-01-01 10:00:00", "u1", "ip", "http://a.com/"),
            ("pageview", "2017-01-01 10:00:00", "u2", "ip", "http://a.com/")]
    s = _sessions(spark, _log(rows), labels=["u1|x", "u1|y", "ghost|z"]).collect()
    assert sorted((r.cookie, r.cookie_label) for r in s) == [("u1", "x"), ("u1", "y"), ("u2", "-")]


def test_host_extraction_and_domain_label(spark):
    from weft.functions.columns import url_host
    urls = {"https://www.baidu.com": "www.baidu.com", "http://a_b.com/x": "a_b.com",
            "http://user:pw@Host.COM:8080/p?q#f": "Host.COM", "http://[::1]:80/": "[::1]",
            "http://h.com/a b": "h.com", "mailto:x@y.com": "-", "not a url": "-", None: "-",
            "file:///etc/x": "-", "https://jd.com": "jd.com"}
    df = spark.createDataFrame([(k,) for k in urls], "u string")
    got = {r.u: r.h for r in df.select("u", url_host("u").alias("h")).collect()}
    assert got == urls


def test_malformed_lines_become_rejects(spark):
    lines = ["#c", "pageview|2017-01-01 10:00:00|u|ip|http://a.com/",
             "pageview|2017-01-01 10:00:00|u|ip",              # short
             "", "pageview|2017-01-01 10:00:00|u|ip|",          # empty url -> short (split)
             "pageview|2017-01-01 10:00:00|u|ip|http://a.com/|extra|fields",
             "click|2017-13-45 99:00:00|u|ip|http://a.com/",    # bad time
             "hhhh|bad|u|ip|x"]                                 # other type: dropped, no reject
    p = clean_log(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert p.rows.count() == 2
    assert sorted(r.reason for r in p.rejects.collect()) == ["bad_time", "short_line", "short_line",
                                                             "short_line"]
    late = clean_log(spark.createDataFrame([("click|2017-13-45 99:00:00|u|ip|http://a.com/|extra|more",)], "value string"))
    assert [r.value for r in late.rejects.collect()] == ["click|2017-13-45 99:00:00|u|ip|http://a.com/|extra|more"]
    with pytest.raises(ValueError):
        p.rows_or_fail()


def test_unknown_strategy_rejected(spark):
    df = spark.createDataFrame([(1, dt.datetime(2020, 1, 1), 1, "pageview")], "u long, t timestamp_ntz, o long, k string")
    with pytest.raises(ValueError):
        cut_sessions(df, SessionSpec("u", "t", "o", "k"), strategy="weekly")
    assert gap_micros("30 minutes") == 1_800_000_000 and gap_micros(5) == 300_000_000
    assert gap_micros("1 hour") == 3_600_000_000 and gap_micros("90 seconds") == 90_000_000
    for bad in ("0 minutes", 0, "soon"):
        with pytest.raises(ValueError):
            gap_micros(bad)


# ---------------------------------------------------------------------------
# Property test against a plain sequential implementation, with one hot
# visitor that the range exchange must cut into many slices.
# ---------------------------------------------------------------------------

def _brute(events, strategy, gap_s=1800):
    by_user = {}
    for e in events:
        if e[3] in ("pageview", "click"):
            by_user.setdefault(e[0], []).append(e)
    out = set()
    for u, rows in by_user.items():
        rows.sort(key=lambda e: (e[1], e[2]))
        sessions, cur, prev = [], [], None
        for e in rows:
            new = (prev is not None and (e[1] - prev[1]).total_seconds() > gap_s) if strategy == "gap" \
                else (e[3] == "pageview" and cur)
            if new:
                sessions.append(cur)
                cur = []
            cur.append(e)
            prev = e
        sessions.append(cur)
        for s in sessions:
            pv = [e for e in s if e[3] == "pageview"]
            out.add((u, s[0][1], s[0][2], s[0][4], pv[0][5] if pv else None, len(pv),
                     sum(e[3] == "click" for e in s)))
    return out


def _events(seed, n, hot_share):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    ev = []
    for i in range(n):
        u = 0 if rnd.random() < hot_share else rnd.randint(1, 6)
        t = base + dt.timedelta(seconds=rnd.choice([0, 1, 60, 1799, 1800, 1801, 3600]) * rnd.randint(0, 40))
        kind = rnd.choice(["pageview", "click", "click", "other"])
        ev.append((u, t, i, kind, f"ip{rnd.randint(0, 3)}", f"url{rnd.randint(0, 9)}"))
    return ev


def _run(spark, events, strategy):
    df = spark.createDataFrame(events, "u long, t timestamp_ntz, o long, k string, ip string, url string")
    spec = SessionSpec("u", "t", "o", "k", first=("ip",), landing=("url",))
    s = cut_sessions(df, spec, strategy=strategy)
    return {(r.u, r.session_start, r.first_order, r.ip, r.landing_url, r.pageview_count, r.click_count)
            for r in s.collect()}


@pytest.fixture
def many_slices(spark):
    keys = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("strategy", ["gap", "pageview"])
def test_hot_visitor_matches_sequential_cut(spark, many_slices, strategy):
    events = _events(7, 1500, hot_share=0.6)
    assert _run(spark, events, strategy) == _brute(events, strategy)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000), n=st.integers(1, 120), hot=st.floats(0.0, 0.9))
def test_random_events_match_sequential_cut(spark, many_slices, seed, n, hot):
    events = _events(seed, n, hot)
    for strategy in ("gap", "pageview"):
        assert _run(spark, events, strategy) == _brute(events, strategy)


def test_pageview_plan_has_no_per_visitor_exchange(spark):
    """The raw rows are never hash-partitioned by the visitor alone."""
    df = spark.createDataFrame(_events(3, 50, 0.5), "u long, t timestamp_ntz, o long, k string, ip string, url string")
    # the per-slice partials are checkpointed once and both branches read
    # them back instead of recomputing the scan and shuffles
    c = cut_sessions(df, SessionSpec("u", "t", "o", "k"), strategy="pageview")
    cplan = c._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in cplan and "Scan ExistingRDD" in cplan
    g = cut_sessions(df, SessionSpec("u", "t", "o", "k"), strategy="gap")
    gplan = g._jdf.queryExecution().executedPlan().toString()
    # First exchange is on (visitor, cell) after a partial aggregate.
    assert "hashpartitioning(_u#" in gplan and "_cell" in gplan and "partial_" in gplan
    assert F is not None


def test_click_runs_spanning_whole_slices(spark, many_slices):
    """Leading clicks over several slices form one session; a long click run
    after a page view attaches to it across slices with no page view."""
    base = dt.datetime(2024, 1, 1)
    ev, i = [], 0
    def add(kind, n):
        nonlocal i
        for _ in range(n):
            ev.append((1, base + dt.timedelta(seconds=i), i, kind, "ip", f"u{i}"))
            i += 1
    add("click", 700)
    add("pageview", 1)
    add("click", 1500)
    add("pageview", 1)
    add("click", 300)
    got = _run(spark, ev, "pageview")
    assert got == _brute(ev, "pageview")
    assert sorted((pv, ck) for *_, pv, ck in got) == [(0, 700), (1, 300), (1, 1500)]


def test_preview_and_schema_print(spark, capsys):
    from weft.sinks.writers import preview, print_schema
    df = spark.createDataFrame([(i,) for i in range(30)], "x int")
    preview(df.orderBy(F.col("x").desc()), 3)
    print_schema(df)
    out = capsys.readouterr().out
    assert "only showing top 3 rows" in out and "|-- x: integer" in out


@pytest.mark.parametrize("strategy", ["gap", "pageview"])
def test_one_event_visitor(spark, strategy):
    rows = [("pageview", "2017-01-01 10:00:00", "solo", "ip9", "http://x.com/p")]
    (r,) = _sessions(spark, _log(rows), labels=["solo|L"], strategy=strategy).collect()
    assert (r.cookie, r.cookie_label, r.ip, r.landing_url, r.domain, r.pageview_count, r.click_count) == \
        ("solo", "L", "ip9", "http://x.com/p", "x.com", 1, 0)


def test_job_pageview_strategy_with_bad_label_line(spark, tmp_path):
    log = write_lines(tmp_path / "visit_log.txt", VISIT_LOG + ["pageview|2024-03-05 08:00:00|v-dan|ip"])
    lab = write_lines(tmp_path / "cookie_label.txt", COOKIE_LABELS + ["nolabel"])
    out = str(tmp_path / "out")
    counts = run_visit_job(spark, log, lab, out, sink="parquet", strategy="pageview")
    assert counts == {"log_rows": 10, "session_count": 5, "reject_count": 2}
    got = {(r.cookie, r.session_server_time, r.landing_url, r.pageview_count, r.click_count)
           for r in spark.read.parquet(f"{out}/trackerSession").collect()}
    assert got == GOLDEN_PAGEVIEW
    assert sorted(r.reason for r in spark.read.parquet(f"{out}/rejects").collect()) == ["short_line", "short_line"]


def test_hot_visitor_with_many_rows_over_many_slices(spark):
    """Far more rows than range sampling looks at; one visitor has most of them."""
    n = 300_000
    ev = (spark.range(n).select(
        F.when(F.col("id") % 5 == 0, F.col("id") % 3 + 1).otherwise(F.lit(0)).alias("u"),
        F.timestamp_add("SECOND", F.col("id"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("t"),
        F.col("id").alias("o"), F.when(F.col("id") % 5000 == 1, F.lit("pageview")).otherwise(F.lit("click")).alias("k")))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted((r.u, r.first_order, r.pageview_count, r.click_count) for r in
                     cut_sessions(ev, SessionSpec("u", "t", "o", "k"), strategy="pageview").collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want, open_ = [], {}
    for i in range(n):
        u = i % 3 + 1 if i % 5 == 0 else 0
        if i % 5000 == 1 or u not in open_:
            open_[u] = [u, i, 0, 0]
            want.append(open_[u])
        open_[u][2 if i % 5000 == 1 else 3] += 1
    assert got == sorted(map(tuple, want))


def test_rows_without_visitor_or_time_are_reported(spark):
    from weft.operators.sessions import unusable_rows
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", t, 1, "click"), (None, t, 2, "click"), ("a", None, 3, "pageview"), (None, None, 4, "other")],
                               "u string, t timestamp_ntz, o long, k string")
    spec = SessionSpec("u", "t", "o", "k")
    assert sorted((r.o, r.reason) for r in unusable_rows(df, spec).collect()) == [(2, "null_visitor"), (3, "null_time")]
    assert cut_sessions(df, spec).count() == 1


def test_counts_without_an_order_column_equal_the_full_cut(spark):
    df = spark.createDataFrame(_events(11, 400, 0.6), "u long, t timestamp_ntz, o long, k string, ip string, url string")
    cols = ["u", "session_start", "pageview_count", "click_count"]
    lean = cut_sessions(df, SessionSpec("u", "t", None, "k"))
    full = cut_sessions(df, SessionSpec("u", "t", "o", "k"))
    assert sorted(tuple(r) for r in lean.select(*cols).collect()) == sorted(tuple(r) for r in full.select(*cols).collect())
    assert "SortAggregate" not in lean._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        cut_sessions(df, SessionSpec("u", "t", None, "k", first=("ip",)))
