"""Line formats: flights, airports, id::json, lenient integers, trim."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.functions.columns import jvm_trim, lenient_int
from weft.operators import stats
from weft.plans import flights
from weft.sources.formats import parse_airports, parse_flights, parse_id_payload, read_csv


def _lines(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def _flight(values):
    return ",".join(values)


GOOD = ["2008", "1", "3", "4", "2003", "1955", "2211", "2225", "WN", "335", "N712SW", "128", "150",
        "116", "-14", "8", "IAD", "TPA", "810", "4", "8", "0", "", "0", "NA", "NA", "NA", "NA", "NA"]


def test_flight_parse_rules(spark):
    odd = list(GOOD)
    odd[4], odd[5], odd[6] = "NA", "x", " 7"          # lenient ints -> -1
    odd[8], odd[16] = "  WN ", " IAD\t"                # strings trimmed like the JVM
    short = list(GOOD[:25]) + ["", "", "", ""]          # trailing empties -> short
    lines = ["Year,Month,DayofMonth,DayOfWeek", _flight(GOOD), _flight(odd), _flight(short), "", "bad,1", ",,,"]
    p = parse_flights(_lines(spark, lines))
    rows = p.rows.collect()
    assert len(rows) == 2
    good = [r for r in rows if r.times.depTime == 2003][0]
    assert good.date.year == 2008 and good.date.dayOfWeek == 4
    assert good.times.actualElapsedTime == 128 and good.times.arrDelay == -14
    assert (good.origin, good.dest, good.distance, good.cancellationCode) == ("IAD", "TPA", 810, "")
    assert good.carrierDelay == -1
    o = [r for r in rows if r.times.depTime == -1][0]
    assert (o.times.crsDepTime, o.times.arrTime, o.uniqueCarrier, o.origin) == (-1, -1, "WN", "IAD")
    assert sorted(r.reason for r in p.rejects.collect()) == ["blank_line", "short_line", "short_line", "short_line"]


def test_lenient_int_table(spark):
    cases = {"7": 7, "+8": 8, "-5": -5, " 7": -1, "7 ": -1, "7\n": -1, "NA": -1, "12NA": -1, "": -1,
             "   ": -1, "x": -1, "1.5": -1, "1e3": -1, "99999999999": -1, "2147483647": 2147483647,
             None: -1}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r.s: r.n for r in df.select("s", lenient_int("s").alias("n")).collect()}
    assert got == cases
    from weft.functions.columns import jvm_trim_sql, lenient_int_sql
    got_sql = {r.s: r.n for r in df.select("s", F.expr(lenient_int_sql("`s`")).alias("n")).collect()}
    assert got_sql == cases
    t = spark.createDataFrame([("\t\n x \x01",)], "s string").select(F.expr(jvm_trim_sql("s")).alias("t"))
    assert t.first().t == "x"


def test_jvm_trim_removes_control_chars(spark):
    df = spark.createDataFrame([("\t\n x \x01",)], "s string")
    assert df.select(jvm_trim("s").alias("t")).first().t == "x"


def test_airports(spark):
    lines = ['"iata","airport","city","state","country","lat","long"',
             '"00M","Thigpen ","Bay Springs","MS","USA",31.95376472,-89.23450472',
             '"X1","N",NA,NA,"Palau",7.3,134.5',
             "bad",
             '"Y","N","C","S","USA",-.-,1']
    p = parse_airports(_lines(spark, lines))
    rows = {r.iata: r for r in p.rows.collect()}
    assert rows["00M"].airport == "Thigpen" and rows["00M"].lat == 31.953763961791992
    assert (rows["X1"].city, rows["X1"].state) == ("NA", "NA")
    assert sorted(r.reason for r in p.rejects.collect()) == ["bad_line", "bad_number"]


def test_id_payload_keeps_later_separators(spark):
    p = parse_id_payload(_lines(spark, ['1::{"a": "x::y"}', "2", "z::{}"]))
    assert [(r.id, r.device) for r in p.rows.collect()] == [(1, '{"a": "x::y"}')]
    assert sorted(r.reason for r in p.rejects.collect()) == ["bad_id", "short_line"]


def test_flight_statistics(spark):
    def f(month, origin, dest, elapsed, dist, canceled):
        v = list(GOOD)
        v[1], v[16], v[17], v[11], v[18], v[21] = str(month), origin, dest, elapsed, str(dist), str(canceled)
        return _flight(v)
    lines = [f(1, "A", "B", "100", 500, 0), f(1, "A", "B", "NA", 500, 1), f(2, "B", "A", "60", 300, 1),
             f(2, "A", "C", "80", 700, 0)]
    fl = parse_flights(_lines(spark, lines)).rows
    assert [tuple(r) for r in stats.cancelled_by_month(fl).collect()] == [(1, 1), (2, 1)]
    assert [tuple(r) for r in stats.route_counts(fl).collect()] == [("A", "B", 2), ("A", "C", 1), ("B", "A", 1)]
    s = flights.elapsed_summary(fl).first()
    assert (s.min_elapsed, s.max_elapsed, s.sum_elapsed) == (-1, 100, 239)   # -1 sentinel included
    cube = {(r.origin, r.dest): r for r in flights.route_cube(fl).collect()}
    assert cube[(None, None)]["count"] == 4 and cube[("A", None)]["avg_distance"] == 1700 / 3
    top = flights.route_cube(fl).first()
    assert top.avg_distance == 700
    cc = {(r.origin, r.dest): r["count"] for r in stats.cube_count(fl, "origin", "dest").collect()}
    assert cc[(None, "A")] == 1 and len(cc) == 3 + 2 + 3 + 1


def test_csv_reader_infers_and_uses_schema(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text("a,b\n1,x\n2,y\n")
    df = read_csv(spark, str(p), header=True, infer_schema=True)
    assert dict(df.dtypes) == {"a": "int", "b": "string"}
    df2 = read_csv(spark, str(p), header=True, schema="a long, b string")
    assert df2.agg(F.sum("a")).first()[0] == 3


def test_persisted_parse_serves_rows_and_rejects_from_one_cache(spark):
    from weft.plans.visits import clean_log
    lines = _lines(spark, ["pageview|2017-01-01 10:00:00|u|ip|http://a.com/", "short|x",
                           "click|2017-99-01 10:00:00|u|ip|http://a.com/"])
    p = clean_log(lines).persist()
    try:
        for df in (p.rows, p.rejects):
            assert "InMemoryRelation" in df._jdf.queryExecution().optimizedPlan().toString()
        assert p.rows.count() == 1
        assert sorted(r.reason for r in p.rejects.collect()) == ["bad_time", "short_line"]
    finally:
        p.unpersist()


def test_cube_with_map_style_aggregates(spark):
    def f(origin, dest, elapsed, dist):
        v = list(GOOD)
        v[16], v[17], v[11], v[18] = origin, dest, elapsed, str(dist)
        return _flight(v)
    fl = parse_flights(_lines(spark, [f("A", "B", "100", 500), f("A", "C", "60", 900)])).rows
    out = stats.cube_agg_map(fl, ["origin", "dest"],
                             {"*": "count", "times.actualElapsedTime": "avg", "distance": "avg"},
                             order_by="avg(distance)")
    assert "avg(distance)" in out.columns and "count(1)" in out.columns
    rows = out.collect()
    assert rows[0]["avg(distance)"] == 900.0
    assert {(r.origin, r.dest) for r in rows if r["avg(distance)"] == 900.0} == {("A", "C"), (None, "C")}
    assert len(out.collect()) == 1 + 1 + 2 + 2


def test_a_line_is_split_once_and_only_the_needed_columns_move(spark):
    one = spark.range(0, 2000, 1, 1).select(F.concat_ws(",", *[F.col("id").cast("string")] * 29).alias("value"))
    plan = parse_flights(one).rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 1 and "Exchange" not in plan
