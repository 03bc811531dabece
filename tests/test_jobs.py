"""End-to-end jobs: flight analysis with its CSV output, label dimensions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import write_lines
from test_formats import GOOD
from weft.operators.labels import DOMAIN_LABELS, attach_unique_label, literal_dimension
from weft.plans import flights
from weft.plans.visits import label_domains
from weft.sources.formats import parse_flights


def _line(origin, dest, month, canceled):
    v = list(GOOD)
    v[1], v[16], v[17], v[21] = str(month), origin, dest, str(canceled)
    return ",".join(v)


def test_flight_analysis_job_writes_ordered_routes(spark, tmp_path):
    lines = ["year,month"] + [_line("ANC", "SEA", 1, 0)] * 3 + [_line("OGG", "ANC", 2, 1)] + \
            [_line("BOS", "SEA", 2, 0)] * 3 + [_line("ABQ", "DEN", 1, 1)]
    path = write_lines(tmp_path / "2008.csv", lines)
    out = str(tmp_path / "info")
    res = flights.flight_analysis(spark, path, routes_out=out)
    assert [tuple(r) for r in res["cancelled_by_month"].collect()] == [(1, 1), (2, 1)]
    routes = [tuple(r) for r in res["route_counts"].collect()]
    assert routes == [("ANC", "SEA", 3), ("BOS", "SEA", 3), ("ABQ", "DEN", 1), ("OGG", "ANC", 1)]
    written = spark.read.schema("origin string, dest string, count long").csv(out)
    assert sorted(tuple(r) for r in written.collect()) == sorted(routes)
    assert res["route_cube_count"].filter(F.col("origin").isNull() & F.col("dest").isNull()).first()["count"] == 8
    assert res["elapsed_summary"].first().sum_elapsed == 8 * 128


def test_domain_labels_from_a_table(spark):
    dim = literal_dimension(spark, DOMAIN_LABELS)
    s = spark.createDataFrame([("https://jd.com/x",), (None,), ("http://a.com",)], "landing_url string")
    got = {(r.landing_url, r.domain, r.domain_label) for r in label_domains(s, "landing_url", dim).collect()}
    assert got == {("https://jd.com/x", "jd.com", "level3"), ("-", "-", "-"), ("http://a.com", "a.com", "-")}
    # duplicate keys in a table dimension keep map semantics (one label per key)
    dup = dim.unionByName(spark.createDataFrame([("jd.com", "level9")], "domain string, domain_label string"))
    one = attach_unique_label(spark.createDataFrame([("jd.com",)], "domain string"), dup, "domain", "domain_label")
    assert [r.domain_label for r in one.collect()] == ["level9"]


def test_command_line_devices_and_flights(spark, tmp_path, capsys):
    from conftest import DEVICE_LINES
    from weft.__main__ import main
    dev = write_lines(tmp_path / "device_info.txt", DEVICE_LINES)
    out_dir = str(tmp_path / "reports")
    main(["devices", dev, "--out", out_dir])
    out = capsys.readouterr().out
    assert "co2_ratio" in out and "68.75" in out
    assert spark.read.parquet(f"{out_dir}/co2_ratio").count() == 3 and spark.read.parquet(f"{out_dir}/json").count() == 4
    many = [_line(f"O{i:04d}", "SEA", 1 + i % 12, i % 2) for i in range(1500)]
    fl = write_lines(tmp_path / "f.csv", many)
    main(["flights", fl, "--routes-out", str(tmp_path / "routes"), "--out", out_dir])
    out = capsys.readouterr().out
    assert "route_counts" in out
    assert spark.read.csv(str(tmp_path / "routes")).count() == 1500
    assert spark.read.parquet(f"{out_dir}/route_counts").count() == 1500  # every row, not the preview


def test_salted_left_join_equals_plain_left_join(spark):
    from weft.operators.labels import attach_label, salted_left_join
    left = spark.createDataFrame([(k, i) for i, k in enumerate([1, 1, 2, 3, 4, 4, 4])], "k long, i long")
    labels = spark.createDataFrame([(1, f"a{j % 3}") for j in range(40)] + [(2, "b"), (2, "b"), (5, "z")],
                                   "k long, lab string")
    plain = sorted(tuple(r) for r in attach_label(left, labels, "k", "lab").collect())
    for rows_per_salt in (1, 5, 1000):
        salted = sorted(tuple(r) for r in salted_left_join(left, labels, "k", "lab", rows_per_salt=rows_per_salt).collect())
        assert salted == plain and len(plain) == 2 * 40 + 2 + 1 + 3
    none = labels.filter("false")
    assert salted_left_join(left, none, "k", "lab").count() == 7
    nulls = labels.union(spark.createDataFrame([(None, "n")], "k long, lab string"))
    assert sorted(tuple(r) for r in salted_left_join(left, nulls, "k", "lab", rows_per_salt=3).collect()) == plain


def test_reports_are_sorted(spark):
    import random

    from weft.operators import stats
    from weft.plans import devices
    rnd = random.Random(5)
    fl = parse_flights(spark.createDataFrame([(_line(rnd.choice("ABCDEFGH") * 3, rnd.choice("XYZ") * 3, rnd.randint(1, 12), rnd.randint(0, 1)),)
                                                      for _ in range(600)], "value string").repartition(7)).rows
    months = [r[0] for r in stats.cancelled_by_month(fl).collect()]
    assert months == sorted(months) and len(months) == 12                                   # G2
    cube = [r.avg_distance for r in flights.route_cube(fl).collect()]
    assert cube == sorted(cube, reverse=True) and len(cube) == 8 * 3 + 8 + 3 + 1            # G6
    dev = spark.createDataFrame([(i, f'{{"device_id": {i}, "cca3": "USA", "temp": {rnd.randint(11, 30)}, "signal": {rnd.randint(16, 25)}, '
                                     f'"c02_level": {rnd.randint(800, 1500)}}}') for i in range(300)], "id long, device string").repartition(7)
    order = [(r.signal, r.temp) for r in devices.country_devices(dev).collect()]
    assert order == sorted(order, reverse=True) and len(order) == 300                       # G4
    ratios = [r.ratio_c02_temperature for r in devices.co2_ratio(dev).collect()]
    assert ratios == sorted(ratios, reverse=True) and len(ratios) == 300                    # G5
    big = spark.createDataFrame([(3_000_000_000, "x"), (7, "y")], "id long, device string")
    assert [r.id for r in devices.cast_columns(big).collect()] == [None, 7]


def test_settings_of_the_platform_are_kept(spark):
    from types import SimpleNamespace

    from pyspark import SparkConf
    from weft import session
    conf = SparkConf(loadDefaults=False).set("spark.sql.session.timeZone", "Asia/Shanghai").set("spark.sql.adaptive.skewJoin.enabled", "false")
    missing = session.missing_defaults(conf)
    assert "spark.sql.session.timeZone" not in missing and "spark.sql.adaptive.skewJoin.enabled" not in missing
    assert "spark.ui.enabled" in missing
    assert session.launch_defaults("yarn", "") == {}
    assert "spark.driver.memory" not in session.launch_defaults("local[2]", "--driver-memory 3g pyspark-shell")
    assert session.launch_defaults(None, "--conf spark.driver.extraJavaOptions=-Xss4m pyspark-shell") == {"spark.driver.memory": "8g"}
    # no shared folder named on a cluster: an error, not a local folder
    sc = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None, getConf=lambda: SparkConf(loadDefaults=False))
    cluster = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda *a: None))
    with pytest.raises(RuntimeError):
        session.checkpoint_dir(cluster)
    path = session.scratch_path(spark, "some")
    spark.range(3).write.parquet(path)
    kept, session._SCRATCH[:] = [p for p in session._SCRATCH if p != path], [path]
    assert session.drop_scratch(spark) == 1
    session._SCRATCH[:] = kept
    with pytest.raises(Exception):
        spark.read.parquet(path).count()


def test_heavy_keys_come_from_one_scan(spark):
    from weft.operators.labels import heavy_keys, salted_left_join
    labels = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 5000)).alias("k"),
                                        F.col("id").cast("string").alias("lab"))
    assert [k for k, _ in heavy_keys(labels, "k", 1000)] == ["hot"]
    left = spark.createDataFrame([("hot", 1), ("k1", 2), ("absent", 3), (None, 4)], "k string, i int")
    plan = salted_left_join(left, labels, "k", "lab", rows_per_salt=1000)
    got = plan.groupBy("k").count().collect()
    assert {(r.k, r["count"]) for r in got} == {("hot", 10_000), ("k1", labels.where("k = 'k1'").count()), ("absent", 1), (None, 1)}
    assert plan.where("k = 'hot'").select("lab").distinct().count() == 10_000


def test_flights_with_their_airports(spark):
    rows = [("A", "B", 1), ("B", "A", 2), ("A", "X", 3), (None, "A", 4)]
    fl = spark.createDataFrame(rows, "origin string, dest string, distance int")
    ports = spark.createDataFrame([("A", "Alpha", "c", "s", "n", 1.5, 2.0), ("A", "Aaa", "c", "s", "n", 0.5, 2.0), ("B", "Beta", "d", "s", "n", 3.0, 4.0)],
                                  "iata string, airport string, city string, state string, country string, lat double, lng double")
    out = flights.with_airports(fl, ports, ("airport", "lat"))
    assert sorted(map(tuple, out.collect()), key=lambda r: r[2]) == [
        ("A", "B", 1, "Alpha", 1.5, "Beta", 3.0), ("B", "A", 2, "Beta", 3.0, "Alpha", 1.5), ("A", "X", 3, "Alpha", 1.5, None, None), (None, "A", 4, None, None, "Alpha", 1.5)]
    shuffled = flights.with_airports(spark.range(10).selectExpr("string(id % 2) AS origin", "string(id % 3) AS dest"), ports)
    plan = shuffled._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan


def test_missing_integers_can_be_null(spark):
    line = spark.createDataFrame([(_line("A", "B", 1, "NA"),), (_line("A", "B", 2, 1),)], "value string")
    assert [r.canceled for r in parse_flights(line).rows.collect()] == [-1, 1]
    assert [r.canceled for r in parse_flights(line, missing=None).rows.collect()] == [None, 1]


def test_lattice_equals_the_cube_of_the_rows(spark):
    from weft.operators import stats
    df = spark.createDataFrame([("a", None, 1, 2.0), ("a", "x", None, 4.0), (None, "x", 3, None), ("b", None, 5, 1.0), ("b", None, 5, 1.0)], "p string, q string, i int, v double")
    got = stats.cube_lattice(df, ["p", "q"], {"n": stats.rows_measure(), "s": stats.sum_measure("i"), "lo": stats.min_measure("v"),
                                              "hi": stats.max_measure("v"), "mean": stats.avg_measure("i")})
    want = df.cube("p", "q").agg(F.count("*").alias("n"), F.sum("i").alias("s"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.avg("i").alias("mean"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.columns == want.columns
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Expand") < plan.index("LogicalRDD") and plan.count("Aggregate") == 2 and "Expand" not in plan[plan.rindex("Aggregate"):]


def test_positions_follow_the_order(spark):
    from weft.operators.order import with_positions
    df = spark.range(5000).selectExpr("id", "id % 7 AS g", "CASE WHEN id % 11 = 0 THEN NULL ELSE id % 100 END AS v").repartition(9)
    got = with_positions(df, [F.col("v").desc(), "id"], position="at")
    rows = sorted(df.collect(), key=lambda r: (r.v is None, -(r.v or 0), r.id))
    assert {(r.id, r["at"]) for r in got.collect()} == {(r.id, k) for k, r in enumerate(rows)}
    own = with_positions(df, ["v", "id"], ["g"], total="n").collect()
    for g in range(7):
        rows = sorted((r for r in df.collect() if r.g == g), key=lambda r: (r.v is not None, r.v or 0, r.id))
        assert {(r.id, r.position) for r in own if r.g == g} == {(r.id, k) for k, r in enumerate(rows)}
        assert {r.n for r in own if r.g == g} == {len(rows)}
    assert with_positions(df.where("false"), ["v"]).collect() == []
