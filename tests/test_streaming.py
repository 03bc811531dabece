"""Streaming gap sessions agree with the batch cut."""

from __future__ import annotations

import datetime as dt

from weft.operators.sessions import SessionSpec, gap_sessions
from weft.streaming import sessions as streaming


def test_streaming_equals_batch_and_append_waits_for_watermark(spark, tmp_path):
    base = dt.datetime(2024, 1, 1)
    rows = [(1, base, 1, "pageview", 1.0), (1, base + dt.timedelta(minutes=30), 2, "click", 2.0),
            (1, base + dt.timedelta(minutes=61), 3, "click", 3.0), (2, base, 4, "click", 4.0),
            (2, base + dt.timedelta(minutes=5), 5, "scroll", 5.0),
            (2, base + dt.timedelta(hours=5), 6, "pageview", 6.0)]
    df = spark.createDataFrame(rows, "u long, t timestamp_ntz, o long, k string, v double")
    src = str(tmp_path / "src")
    df.coalesce(1).write.parquet(src)
    spec = SessionSpec("u", "t", "o", "k", first=("v",))
    batch = {(r.u, r.session_start, r.pageview_count, r.click_count, r.v)
             for r in gap_sessions(df, spec).collect()}
    stream = streaming.file_stream(spark, src, df.schema)
    out = str(tmp_path / "out")
    q = streaming.write_parquet(streaming.gap_sessions(stream, spec), out, str(tmp_path / "ck"),
                                mode="complete", available_now=True)
    q.awaitTermination()
    got = {(r.u, r.session_start, r.pageview_count, r.click_count, r.v) for r in spark.read.parquet(out).collect()}
    assert got == batch and len(got) == 4
    # append: the sessions still open at the last watermark are not emitted yet
    out2 = str(tmp_path / "out2")
    q2 = streaming.write_parquet(streaming.gap_sessions(file_stream := streaming.file_stream(spark, src, df.schema),
                                                        spec), out2, str(tmp_path / "ck2"),
                                 mode="append", available_now=True)
    q2.awaitTermination()
    assert file_stream.isStreaming
    emitted = spark.read.parquet(out2).count() if (tmp_path / "out2").exists() else 0
    assert emitted < len(batch)


def test_registered_stream_reads_a_table_of_part_files(spark, tmp_path):
    import shutil

    from weft.plans import catalog
    small = "/root/testdata/sf0.001"
    shutil.copytree(small, tmp_path / "sf", ignore=lambda d, names: [n for n in names if n != "customer.parquet"])
    spark.read.parquet(f"{small}/events.parquet").repartition(3).write.parquet(str(tmp_path / "sf" / "events.parquet"))
    cols = catalog.streaming_gap_sessions(spark, small).columns
    one = sorted(tuple(r) for r in catalog.streaming_gap_sessions(spark, small).collect())
    parts = sorted(tuple(r) for r in catalog.streaming_gap_sessions(spark, str(tmp_path / "sf")).select(*cols).collect())
    assert one == parts and one


def test_times_do_not_depend_on_the_session_time_zone(spark, tmp_path):
    df = spark.createDataFrame([(1, dt.datetime(2024, 3, 31, 2, 30), 1, "click"), (1, None, 2, "click"), (None, dt.datetime(2024, 3, 31), 3, "click")],
                               "u long, t timestamp_ntz, o long, k string")
    src = str(tmp_path / "src")
    df.coalesce(1).write.parquet(src)
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")  # this local time does not exist there
    try:
        before = {k: spark.conf.get(k, None) for k in streaming.STREAM_SETTINGS}
        q = streaming.write_parquet(streaming.gap_sessions(streaming.file_stream(spark, src, df.schema), SessionSpec("u", "t", "o", "k")),
                                    str(tmp_path / "out"), str(tmp_path / "ck"), mode="complete", available_now=True)
        q.awaitTermination()
        (r,) = spark.read.parquet(str(tmp_path / "out")).collect()
        assert r.session_start == dt.datetime(2024, 3, 31, 2, 30) and r.session_end == dt.datetime(2024, 3, 31, 3, 0)
        assert before == {k: spark.conf.get(k, None) for k in streaming.STREAM_SETTINGS}
        assert streaming.late_rows(q) == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_streaming_page_views_equal_batch_and_their_state_goes(spark, tmp_path):
    import json
    import random

    from weft.operators.sessions import cut_sessions
    from weft.streaming import pageviews
    rnd = random.Random(2)
    base = dt.datetime(2024, 1, 1)
    rows = [(rnd.choice([1, 2, 3]), base + dt.timedelta(minutes=rnd.randrange(3000)), k, rnd.choice(["pageview", "click", "click", "scroll"]),
             None if k % 5 == 0 else k, rnd.choice([None, "ü"])) for k in range(300)]
    rows += [(7, base, 1000, "click", 5, "x"), (None, base, 1001, "click", 5, "x"), (7, None, 1002, "click", 5, "x")]
    df = spark.createDataFrame(rows, "u long, t timestamp_ntz, o long, k string, n int, s string")
    spec = SessionSpec("u", "t", "o", "k", first=("n", "s"), landing=("s", "t"))
    want = sorted(str(tuple(r)) for r in cut_sessions(df, spec, "pageview").collect())
    src, end = str(tmp_path / "src"), str(tmp_path / "end")
    ordered = df.orderBy("t")
    ordered.repartitionByRange(4, "t").write.parquet(src)  # four files, one a micro-batch, each a stretch of time
    streaming.write_end_mark(df, spec, end, after="30 days")
    # the mark comes last: it would make the rows of later files late
    first = pageviews.pageview_sessions(streaming.file_stream(spark, src, df.schema, max_files_per_trigger=10), spec, watermark="3 days", idle="9 days")
    q = streaming.write_parquet(first, str(tmp_path / "out1"), str(tmp_path / "ck1"), available_now=True)
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out1")).count() < len(want)  # the last ones may still grow
    both = streaming.file_stream(spark, src, df.schema).union(streaming.file_stream(spark, end, df.schema))
    q = streaming.write_parquet(pageviews.pageview_sessions(both, spec, watermark="3 days", idle="9 days"), str(tmp_path / "out2"), str(tmp_path / "ck2"), available_now=True)
    q.awaitTermination()
    assert sorted(str(tuple(r)) for r in spark.read.parquet(str(tmp_path / "out2")).collect()) == want
    left = json.loads(q.lastProgress.json)["stateOperators"][0]["numRowsTotal"]
    assert left == 1  # the mark's own


def test_a_click_after_the_timer_opens_a_session():
    from weft.streaming.pageviews import _Visitor
    visitor = _Visitor([(5, 1, False, "f1", None), (9, 2, True, "f2", "l2"), (12, 3, False, "f3", None), (40, 4, False, "f4", None), (41, 5, True, "f5", "l5")])
    assert list(visitor.take(12, 20)) == [[5, 1, "f1", None, 0, 1, 5]] and visitor.wakes(20) == 32
    assert list(visitor.take(39, 20)) == [[9, 2, "f2", "l2", 1, 1, 12]] and visitor.wakes(20) == 40
    assert list(visitor.take(45, 20)) == [[40, 4, "f4", None, 0, 1, 40]] and visitor.wakes(20) == 61
    assert list(visitor.take(62, 20)) == [[41, 5, "f5", "l5", 1, 0, 41]] and visitor.wakes(20) is None
