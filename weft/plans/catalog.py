"""Registered queries over the driver's test tables, with DuckDB oracles.

Each query maps a reference operator onto the test tables (SURVEY §7.3):
``events`` plays the visit log (``view`` = page view, ``user_id`` = cookie,
``props.k`` = the page visited), ``pages`` gives landing URLs, ``customer``
gives cookie labels, ``orders`` / ``lineitem`` play the flight records, and
``nation`` / ``region`` feed the nested JSON. Every query reads whole
tables; none samples or caps rows (``route_top20`` is a top-k report).

``ORACLES[name]`` is SQL for the same result that DuckDB runs on the same
parquet files; column names match the Spark output.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft import schemas
from weft.functions.columns import (epoch_micros, exact_round_ratio, floor_div, lenient_int,
                                    session_hash_id, ts_text, url_host)
from weft.operators import jsonops, stats
from weft.operators.incremental import SessionStore
from weft.operators.labels import DOMAIN_LABELS, attach_label, map_lookup, salted_left_join
from weft.operators.order import with_positions
from weft.operators.sessions import SessionSpec, cut_sessions, gap_micros, with_session_id
from weft.plans import devices, flights
from weft.plans.visits import build_sessions, label_domains, read_log
from weft.session import scratch_path
from weft.sinks.writers import read_text_records, write_csv, write_parquet, write_text
from weft.sources.formats import (parse_airports, parse_cookie_labels, parse_flights, parse_id_payload,
                                  infer_csv, parse_visit_log, read_json, read_lines)

Query = Callable[[SparkSession, str], DataFrame]

# A literal domain -> label dimension for hosts of the test
# pages (the reference's own dimension has no host in common with them).
TEST_DOMAIN_LABELS = {
    "blog.tionsh.example.net": "level1",
    "thther.example.org": "level2",
    "blog.ththan.example.net": "level3",
    "www.cheap-pills.example.com": "spam",
    "www.casino-win.example.org": "spam",
    "spam-farm.example.org": "spam",
}
URL_HOST_SQL = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?([^/:?#]*)"


# Header lines of the two flat-file formats.
FLIGHT_HEADER = ("Year,Month,DayofMonth,DayOfWeek,DepTime,CRSDepTime,ArrTime,CRSArrTime,UniqueCarrier,"
                 "FlightNum,TailNum,ActualElapsedTime,CRSElapsedTime,AirTime,ArrDelay,DepDelay,Origin,Dest,"
                 "Distance,TaxiIn,TaxiOut,Cancelled,CancellationCode,Diverted,CarrierDelay,WeatherDelay,"
                 "NASDelay,SecurityDelay,LateAircraftDelay")
AIRPORT_HEADER = '"iata","airport","city","state","country","lat","long"'


def _with_header(spark: SparkSession, body: DataFrame, header: str) -> DataFrame:
    """A header line followed by the body lines (the header row is a JVM-side
    one-row relation, no Python worker)."""
    head = spark.range(0, 1, 1, 1).select(F.lit(header).alias("value"))
    return head.unionByName(body)


def _dealt(spark: SparkSession, sf_dir: str, name: str, columns: list[str], key: list[str]) -> DataFrame:
    """The columns of a table that its text lines use, dealt by a key: the
    packing and parsing of lines is most of these queries' work, and a table
    may be one row group."""
    return _t(spark, sf_dir, name).select(*columns).repartition(*key)


_TABLES: dict[tuple[str, str], DataFrame] = {}


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; the DataFrame is reused per application, session and
    path, so its Parquet schema is read once rather than once per query."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # Spark Connect
        app = str(id(spark))
    key = (app, path)
    df = _TABLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = _TABLES[key] = spark.read.parquet(path)
    return df


def _sql_values(mapping: dict[str, str]) -> str:
    return ", ".join(f"('{k}', '{v}')" for k, v in sorted(mapping.items()))


# --------------------------------------------------------------------------
# Sessions over events
# --------------------------------------------------------------------------

EVENT_SPEC = SessionSpec(user="user_id", ts="ts", order="event_id", kind="event_type",
                         pageview="view", click="click", first=("value",), landing=("page",))


def _events_for_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _t(spark, sf_dir, "events")
    return ev.select("event_id", "ts", "user_id", "event_type", "value",
                     F.get_json_object("props", "$.k").try_cast("long").alias("page"))


def event_sessions(spark: SparkSession, sf_dir: str, strategy: str = "gap") -> DataFrame:
    """Full session rows: id, start, first row, landing page / URL / host /
    domain label, counts, cookie label (F1-F4, E2-E4, G1, I8-I10, D1-D3)."""
    s = cut_sessions(_events_for_sessions(spark, sf_dir), EVENT_SPEC, strategy=strategy)
    s = with_session_id(s, "user_id")
    # Sessions leave the cut hash-partitioned by visitor: join the cookie
    # labels first so only the label side moves, then the landing pages.
    labels = _t(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("cookie_label"))
    s = attach_label(s, labels, "user_id", "cookie_label", label_key="c_custkey")
    # Spark broadcasts ``pages`` only when its measured size allows it.
    pages = _t(spark, sf_dir, "pages").select("page_id", F.col("url").alias("landing_url"))
    s = s.join(pages, s["landing_page"] == pages["page_id"], "left").drop("page_id")
    s = label_domains(s, "landing_url", TEST_DOMAIN_LABELS)
    return s.select("session_id", "user_id", "session_start",
                    F.col("first_order").alias("first_event_id"),
                    F.col("value").alias("first_value"),
                    F.col("landing_page").alias("landing_page_id"),
                    "landing_url", "domain", "domain_label",
                    "pageview_count", "click_count", "cookie_label")


def _sessions_sql(cut: str) -> str:
    return f"""
WITH e AS (
  SELECT event_id, ts, user_id, event_type, value, TRY_CAST(props->>'$.k' AS BIGINT) AS page
  FROM events WHERE event_type IN ('view', 'click') AND ts IS NOT NULL AND user_id IS NOT NULL),
f AS (SELECT *, {cut} AS nw FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
g AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY ts, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seq FROM f),
s AS (SELECT user_id, min(ts) AS session_start,
             arg_min(event_id, (ts, event_id)) AS first_event_id,
             arg_min(value, (ts, event_id)) AS first_value,
             arg_min(page, (ts, event_id)) FILTER (WHERE event_type = 'view') AS landing_page_id,
             CAST(count(*) FILTER (WHERE event_type = 'view') AS INTEGER) AS pageview_count,
             CAST(count(*) FILTER (WHERE event_type = 'click') AS INTEGER) AS click_count
      FROM g GROUP BY user_id, seq),
h AS (SELECT s.*, coalesce(p.url, '-') AS landing_url,
             CASE WHEN p.url IS NULL THEN '-'
                  ELSE coalesce(nullif(regexp_extract(p.url, '{URL_HOST_SQL}', 1), ''), '-') END AS domain
      FROM s LEFT JOIN pages p ON p.page_id = s.landing_page_id)
SELECT sha256(concat_ws('|', CAST(h.user_id AS VARCHAR), strftime(h.session_start, '%Y-%m-%d %H:%M:%S.%f'),
                        CAST(h.first_event_id AS VARCHAR))) AS session_id,
       h.user_id, h.session_start, h.first_event_id, h.first_value, h.landing_page_id,
       h.landing_url, h.domain, coalesce(dl.label, '-') AS domain_label,
       h.pageview_count, h.click_count, coalesce(c.c_mktsegment, '-') AS cookie_label
FROM h
LEFT JOIN (VALUES {_sql_values(TEST_DOMAIN_LABELS)}) dl(domain, label) ON dl.domain = h.domain
LEFT JOIN customer c ON c.c_custkey = h.user_id
"""


GAP_CUT_SQL = ("CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL 30 MINUTE "
               "THEN 1 ELSE 0 END")
PAGEVIEW_CUT_SQL = "CASE WHEN event_type = 'view' THEN 1 ELSE 0 END"

# Plain per-session rows (user, start, counts) used by the join / count queries.
_CORE_SQL = """
WITH e AS (SELECT * FROM events WHERE event_type IN ('view', 'click') AND ts IS NOT NULL AND user_id IS NOT NULL),
f AS (SELECT *, {cut} AS nw FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
g AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY ts, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seq FROM f)
SELECT user_id, min(ts) AS session_start, max(ts) AS last_event, CAST(count(*) AS BIGINT) AS event_count
FROM g GROUP BY user_id, seq"""


def _core_sessions(spark: SparkSession, sf_dir: str, strategy: str = "gap") -> DataFrame:
    """Start and counts only: the gap strategy needs no row order for these."""
    spec = SessionSpec(user="user_id", ts="ts", order=None if strategy == "gap" else "event_id", kind="event_type",
                       pageview="view", click="click")
    ev = _t(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return cut_sessions(ev, spec, strategy=strategy)


def gap_sessions(spark, sf_dir):
    return event_sessions(spark, sf_dir, "gap")


def pageview_sessions(spark, sf_dir):
    return event_sessions(spark, sf_dir, "pageview")


def gap_sessions_native(spark, sf_dir):
    """Gap sessions with the built-in ``session_window`` (F1).

    ``session_window`` alone shuffles every row of a visitor to one task.
    Here it runs over the per-(visitor, gap-wide cell) first and last times
    only: inside a cell the rows' ``[t, t+gap]`` windows already overlap, so
    those two points span the same union. The cell aggregate combines
    map-side, so a hot visitor costs at most two points per cell.
    """
    g = gap_micros("30 minutes")
    ev = (_t(spark, sf_dir, "events").filter(F.col("event_type").isin("view", "click"))
          .filter(F.col("ts").isNotNull() & F.col("user_id").isNotNull()))
    cell = floor_div(epoch_micros("ts"), g)
    cells = ev.groupBy("user_id", cell.alias("cell")).agg(
        F.min("ts").alias("lo"), F.max("ts").alias("hi"), F.count(F.lit(1)).alias("n"))
    points = cells.select("user_id", F.explode(F.array(
        F.struct(F.col("lo").alias("t"), F.col("n").alias("n")),
        F.struct(F.col("hi").alias("t"), F.lit(0).cast("long").alias("n")))).alias("p"))
    s = (points.groupBy("user_id", F.session_window("p.t", "30 minutes").alias("w"))
               .agg(F.sum("p.n").alias("event_count")))
    return s.select("user_id", F.col("w.start").alias("session_start"),
                    F.col("w.end").alias("session_end"), "event_count")


GAP_NATIVE_SQL = _CORE_SQL.format(cut=GAP_CUT_SQL).replace(
    "max(ts) AS last_event", "max(ts) + INTERVAL 30 MINUTE AS session_end")
GAP_NATIVE_SQL = f"SELECT user_id, session_start, session_end, event_count FROM ({GAP_NATIVE_SQL})"


PERIODS = 3


def incremental_gap_sessions(spark, sf_dir):
    """Gap sessions of ``events`` given one period of days at a time: what is open at the end of
    a period is carried to the next (F1, F4). The rows are those of one cut."""
    ev = _events_for_sessions(spark, sf_dir)
    store = SessionStore(spark, scratch_path(spark, "session-store"), EVENT_SPEC)
    first, last = ev.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    if first is None:
        return with_session_id(cut_sessions(ev, EVENT_SPEC), "user_id").select(*INCREMENTAL_COLUMNS)
    days = -(-((last - first).days + 1) // PERIODS)
    for k in range(PERIODS):
        start = first + datetime.timedelta(days=days * k)
        store.advance(ev, start.isoformat(), start, start + datetime.timedelta(days=days))
    return with_session_id(store.sessions(), "user_id").select(*INCREMENTAL_COLUMNS)


INCREMENTAL_COLUMNS = ["session_id", "user_id", "session_start", "first_order", "value", "landing_page", "pageview_count", "click_count"]
INCREMENTAL_SQL = f"""
SELECT session_id, user_id, session_start, first_event_id AS first_order, first_value AS value, landing_page_id AS landing_page,
       pageview_count, click_count FROM ({_sessions_sql(GAP_CUT_SQL)})"""


def session_count(spark, sf_dir):
    """Number of sessions per strategy (E10's count, as a result). Page-view
    sessions need no cut to be counted: every page view opens one, and so do a
    visitor's clicks before the first page view."""
    gap = _core_sessions(spark, sf_dir, "gap").agg(F.count(F.lit(1)).alias("session_count"))
    order = F.struct("ts", "event_id")
    view = F.col("event_type") == "view"
    visitors = (_t(spark, sf_dir, "events").filter(F.col("event_type").isin("view", "click"))
                .filter(F.col("ts").isNotNull() & F.col("user_id").isNotNull())
                .groupBy("user_id").agg(F.count_if(view).alias("views"), F.min(order).alias("first"), F.min(F.when(view, order)).alias("first_view")))
    leads = F.coalesce((F.col("first") < F.col("first_view")), F.lit(True)).cast("long")
    pv = visitors.agg(F.coalesce(F.sum(F.col("views") + leads), F.lit(0)).alias("session_count"))
    return (gap.select(F.lit("gap").alias("strategy"), "session_count")
               .unionByName(pv.select(F.lit("pageview").alias("strategy"), "session_count")))


SESSION_COUNT_SQL = f"""
SELECT 'gap' AS strategy, count(*) AS session_count FROM ({_CORE_SQL.format(cut=GAP_CUT_SQL)})
UNION ALL
SELECT 'pageview' AS strategy, count(*) AS session_count FROM ({_CORE_SQL.format(cut=PAGEVIEW_CUT_SQL)})"""


def session_id_hash(spark, sf_dir):
    """Deterministic id over (visitor, formatted time, row id) for every event."""
    ev = _t(spark, sf_dir, "events")
    return ev.select("event_id", session_hash_id("user_id", ts_text("ts"), "event_id").alias("row_hash"))


SESSION_ID_HASH_SQL = """
SELECT event_id, sha256(concat_ws('|', CAST(user_id AS VARCHAR), strftime(ts, '%Y-%m-%d %H:%M:%S.%f'),
                                  CAST(event_id AS VARCHAR))) AS row_hash
FROM events"""


def event_type_filter(spark, sf_dir):
    """Keep page views and clicks."""
    ev = _t(spark, sf_dir, "events")
    return ev.filter(F.col("event_type").isin("view", "click")).select("event_id", "user_id", "event_type")


# --------------------------------------------------------------------------
# Hosts and labels
# --------------------------------------------------------------------------

def url_host_query(spark, sf_dir):
    pages = _t(spark, sf_dir, "pages")
    return pages.select("page_id", "url", url_host("url").alias("host"))


URL_HOST_QUERY_SQL = f"""
SELECT page_id, url, coalesce(nullif(regexp_extract(url, '{URL_HOST_SQL}', 1), ''), '-') AS host
FROM pages"""


def domain_label(spark, sf_dir):
    """Exact-host label from a literal dimension, ``-`` when absent."""
    pages = _t(spark, sf_dir, "pages").select("page_id", url_host("url").alias("domain"))
    return pages.select("page_id", "domain", map_lookup("domain", TEST_DOMAIN_LABELS).alias("domain_label"))


DOMAIN_LABEL_SQL = f"""
WITH p AS (SELECT page_id, coalesce(nullif(regexp_extract(url, '{URL_HOST_SQL}', 1), ''), '-') AS domain FROM pages)
SELECT p.page_id, p.domain, coalesce(dl.label, '-') AS domain_label
FROM p LEFT JOIN (VALUES {_sql_values(TEST_DOMAIN_LABELS)}) dl(domain, label) ON dl.domain = p.domain"""


def user_label_left_join(spark, sf_dir):
    """Sessions left-joined to labels that exist only for some visitors
    (customers in credit); the rest get ``-`` (D1, D2)."""
    s = _core_sessions(spark, sf_dir, "gap").select("user_id", "session_start")
    labels = (_t(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 0)
              .select("c_custkey", F.col("c_mktsegment").alias("cookie_label")))
    return attach_label(s, labels, "user_id", "cookie_label", label_key="c_custkey")


USER_LABEL_SQL = f"""
SELECT s.user_id, s.session_start, coalesce(c.c_mktsegment, '-') AS cookie_label
FROM ({_CORE_SQL.format(cut=GAP_CUT_SQL)}) s
LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON c.c_custkey = s.user_id"""


def label_fanout(spark, sf_dir):
    """A label side with repeated keys multiplies rows, as a left join does
    (D1). Label keys with very many rows are salted (``salted_left_join``)."""
    s = _core_sessions(spark, sf_dir, "gap").select("user_id", "session_start")
    labels = _t(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderpriority").alias("cookie_label"))
    return salted_left_join(s, labels, "user_id", "cookie_label", label_key="o_custkey")


LABEL_FANOUT_SQL = f"""
SELECT s.user_id, s.session_start, coalesce(o.o_orderpriority, '-') AS cookie_label
FROM ({_CORE_SQL.format(cut=GAP_CUT_SQL)}) s
LEFT JOIN orders o ON o.o_custkey = s.user_id"""


# --------------------------------------------------------------------------
# Line formats (data packed from the tables, then parsed back)
# --------------------------------------------------------------------------

def _visit_log_lines(spark, sf_dir) -> DataFrame:
    """Events as pipe lines; ``error`` events become ``#`` comment lines and
    ``signup`` events lose their last two fields (short lines)."""
    ev = _dealt(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "props"], ["event_id"])
    full = F.concat_ws("|", "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
                       F.col("user_id").cast("string"), F.col("event_id").cast("string"), "props")
    short = F.concat_ws("|", "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
                        F.col("user_id").cast("string"))
    line = (F.when(F.col("event_type") == "error", F.concat(F.lit("#"), full))
             .when(F.col("event_type") == "signup", short)
             .otherwise(full))
    return ev.select(line.alias("value"))


def parse_pipe_line(spark, sf_dir):
    """Pipe-delimited log parsing."""
    p = parse_visit_log(_visit_log_lines(spark, sf_dir), order_col=None)
    return p.rows


PARSE_PIPE_SQL = """
SELECT event_type AS log_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS log_server_time,
       CAST(user_id AS VARCHAR) AS cookie, CAST(event_id AS VARCHAR) AS ip, props AS url
FROM events WHERE event_type NOT IN ('error', 'signup')"""


def parse_id_payload_query(spark, sf_dir):
    """``id::payload`` lines."""
    ev = _t(spark, sf_dir, "events")
    lines = ev.select(F.concat(F.col("event_id").cast("string"), F.lit("::"), "props").alias("value"))
    return parse_id_payload(lines).rows


PARSE_ID_PAYLOAD_SQL = "SELECT event_id AS id, props AS device FROM events"


def _flight_lines(spark, sf_dir) -> DataFrame:
    """Lineitem rows as 29-field flight lines with ``NA``, blanks, signs and
    padding in integer positions; ``R`` rows end in empty fields (short)."""
    li = _dealt(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                                            "l_returnflag", "l_linestatus", "l_shipdate"], ["l_orderkey", "l_linenumber"])
    s = lambda c: F.col(c).cast("string")
    ln = s("l_linenumber")
    qty = F.col("l_quantity").cast("int").cast("string")
    short = F.col("l_returnflag") == "R"
    tail = [ln, F.lit("NA"), F.lit(""), F.lit("12NA"), qty]
    fields = [
        F.year("l_shipdate").cast("string"), F.month("l_shipdate").cast("string"),
        F.dayofmonth("l_shipdate").cast("string"), F.dayofweek("l_shipdate").cast("string"),
        ln, F.lit("NA"), qty, F.lit(""),
        F.concat(F.lit(" "), F.col("l_returnflag"), F.lit(" ")), s("l_orderkey"), s("l_linestatus"),
        s("l_partkey"), s("l_suppkey"), F.lit("x"), F.concat(F.lit("+"), ln), F.concat(F.lit("-"), ln),
        F.col("l_returnflag"), F.col("l_linestatus"), F.floor("l_extendedprice").cast("int").cast("string"),
        F.lit(" 7"), ln, F.when(F.col("l_linestatus") == "F", "1").otherwise("0"),
        F.col("l_returnflag"), F.lit("0"),
        *[F.when(short, F.lit("")).otherwise(t) for t in tail],
    ]
    body = li.select(F.concat_ws(",", *fields).alias("value"))
    return _with_header(spark, body, FLIGHT_HEADER)


def _flat_flights(df: DataFrame) -> DataFrame:
    return df.select("date.*", "times.*", *[f.name for f in schemas.FLIGHT.fields[2:]])


def parse_wide_csv(spark, sf_dir):
    """29-field flight lines to the nested record, flattened."""
    return _flat_flights(parse_flights(_flight_lines(spark, sf_dir)).rows)


PARSE_WIDE_CSV_SQL = """
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
       CAST(day(l_shipdate) AS INTEGER) AS dayOfMonth, CAST(dayofweek(l_shipdate) + 1 AS INTEGER) AS dayOfWeek,
       l_linenumber AS depTime, -1 AS crsDepTime, CAST(l_quantity AS INTEGER) AS arrTime, -1 AS crsArrTime,
       CAST(l_partkey AS INTEGER) AS actualElapsedTime, CAST(l_suppkey AS INTEGER) AS crsElapsedTime,
       -1 AS airTime, l_linenumber AS arrDelay, -l_linenumber AS depDelay, -1 AS taxiIn,
       l_linenumber AS taxiOut,
       l_returnflag AS uniqueCarrier, CAST(l_orderkey AS INTEGER) AS flightNum, l_linestatus AS tailNum,
       l_returnflag AS origin, l_linestatus AS dest, CAST(floor(l_extendedprice) AS INTEGER) AS distance,
       CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS canceled, l_returnflag AS cancellationCode,
       0 AS diverted, l_linenumber AS carrierDelay, -1 AS weatherDelay, -1 AS nasDelay, -1 AS securityDelay,
       CAST(l_quantity AS INTEGER) AS lateAircraftDelay
FROM lineitem WHERE l_returnflag <> 'R'"""


def flight_elapsed_summary(spark, sf_dir):
    """min / max / avg / sum of elapsed time over parsed flight lines."""
    return flights.elapsed_summary(parse_flights(_flight_lines(spark, sf_dir)).rows)


FLIGHT_ELAPSED_SQL = """
SELECT CAST(min(l_partkey) AS INTEGER) AS min_elapsed, CAST(max(l_partkey) AS INTEGER) AS max_elapsed,
       avg(l_partkey) AS avg_elapsed, CAST(sum(l_partkey) AS BIGINT) AS sum_elapsed
FROM lineitem WHERE l_returnflag <> 'R'"""


def lenient_int_query(spark, sf_dir):
    """Lenient integers on text built from lineitem."""
    li = _t(spark, sf_dir, "lineitem")
    pk = F.col("l_partkey").cast("string")
    s = (F.when(F.col("l_linenumber") == 1, pk)
          .when(F.col("l_linenumber") == 2, F.concat(pk, F.lit("NA")))
          .when(F.col("l_linenumber") == 3, F.concat(F.lit(" "), pk))
          .when(F.col("l_linenumber") == 4, F.concat(F.lit("+"), pk))
          .when(F.col("l_linenumber") == 5, F.concat(F.lit("-"), pk))
          .when(F.col("l_linenumber") == 6, F.concat(pk, F.lit("x")))
          .otherwise(F.concat(pk, F.lit("9999999999"))))
    return li.select("l_orderkey", "l_linenumber", s.alias("s")).select(
        "l_orderkey", "l_linenumber", "s", lenient_int("s").alias("n"))


LENIENT_INT_SQL = """
WITH t AS (
  SELECT l_orderkey, l_linenumber,
         CASE l_linenumber WHEN 1 THEN CAST(l_partkey AS VARCHAR)
                           WHEN 2 THEN CAST(l_partkey AS VARCHAR) || 'NA'
                           WHEN 3 THEN ' ' || CAST(l_partkey AS VARCHAR)
                           WHEN 4 THEN '+' || CAST(l_partkey AS VARCHAR)
                           WHEN 5 THEN '-' || CAST(l_partkey AS VARCHAR)
                           WHEN 6 THEN CAST(l_partkey AS VARCHAR) || 'x'
                           ELSE CAST(l_partkey AS VARCHAR) || '9999999999' END AS s
  FROM lineitem)
SELECT l_orderkey, l_linenumber, s,
       CASE WHEN trim(s) = '' OR trim(s) LIKE '%NA' THEN -1
            WHEN regexp_full_match(s, '[+-]?[0-9]+') THEN coalesce(TRY_CAST(s AS INTEGER), -1)
            ELSE -1 END AS n
FROM t"""


def _airport_lines(spark, sf_dir) -> DataFrame:
    """Nations as quoted airport lines: padded names, unquoted ``NA`` city
    and state in region 0, non-numeric latitude in region 4 (a reject)."""
    n = _t(spark, sf_dir, "nation")
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    k = F.col("n_nationkey").cast("string")
    r0 = F.col("n_regionkey") == 0
    lat = F.when(F.col("n_regionkey") == 4, F.lit("-.-")).otherwise(
        (F.col("n_nationkey") * F.lit(1.25)).cast("string"))
    lng = (-(F.col("n_regionkey") * F.lit(0.5) + F.lit(0.125))).cast("string")
    fields = [q(F.col("n_name")), q(F.concat(F.lit("Port "), k, F.lit(" "))),
              F.when(r0, F.lit("NA")).otherwise(q(F.concat(F.lit("City"), k))),
              F.when(r0, F.lit("NA")).otherwise(q(F.concat(F.lit("S"), F.col("n_regionkey").cast("string")))),
              q(F.lit("Country")), lat, lng]
    body = n.select(F.concat_ws(",", *fields).alias("value"))
    return _with_header(spark, body, AIRPORT_HEADER)


def parse_quoted_regex(spark, sf_dir):
    """Airport lines by pattern with float-precision coordinates."""
    return parse_airports(_airport_lines(spark, sf_dir)).rows


PARSE_QUOTED_SQL = """
SELECT n_name AS iata, 'Port ' || CAST(n_nationkey AS VARCHAR) AS airport,
       CASE WHEN n_regionkey = 0 THEN 'NA' ELSE 'City' || CAST(n_nationkey AS VARCHAR) END AS city,
       CASE WHEN n_regionkey = 0 THEN 'NA' ELSE 'S' || CAST(n_regionkey AS VARCHAR) END AS state,
       'Country' AS country,
       CAST(CAST(CAST(n_nationkey AS DOUBLE) * 1.25 AS FLOAT) AS DOUBLE) AS lat,
       CAST(CAST(-(CAST(n_regionkey AS DOUBLE) * 0.5 + 0.125) AS FLOAT) AS DOUBLE) AS lng
FROM nation WHERE n_regionkey <> 4"""


def rejects(spark, sf_dir):
    """Rejected lines counted by source and reason."""
    log = parse_visit_log(_visit_log_lines(spark, sf_dir), order_col=None).rejects
    fl = parse_flights(_flight_lines(spark, sf_dir)).rejects
    ap = parse_airports(_airport_lines(spark, sf_dir)).rejects
    allr = (log.withColumn("source", F.lit("visit_log"))
            .unionByName(fl.withColumn("source", F.lit("flights")))
            .unionByName(ap.withColumn("source", F.lit("airports"))))
    return allr.groupBy("source", "reason").agg(F.count(F.lit(1)).alias("rejected"))


REJECTS_SQL = """
SELECT 'visit_log' AS source, 'short_line' AS reason, count(*) AS rejected FROM events WHERE event_type = 'signup'
UNION ALL
SELECT 'flights', 'short_line', count(*) FROM lineitem WHERE l_returnflag = 'R'
UNION ALL
SELECT 'airports', 'bad_number', count(*) FROM nation WHERE n_regionkey = 4"""


# --------------------------------------------------------------------------
# Statistics
# --------------------------------------------------------------------------

def _orders_as_flights(spark, sf_dir) -> DataFrame:
    o = _t(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    return o.select(
        F.struct(F.year(d).alias("year"), F.month(d).alias("month"),
                 F.dayofmonth(d).alias("dayOfMonth"), F.dayofweek(d).alias("dayOfWeek")).alias("date"),
        (F.col("o_orderstatus") == "F").cast("int").alias("canceled"))


def cancelled_by_month(spark, sf_dir):
    """Cancelled (status F) per month of a nested date struct."""
    return stats.cancelled_by_month(_orders_as_flights(spark, sf_dir))


CANCELLED_SQL = """
SELECT CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS count
FROM orders WHERE o_orderstatus = 'F' GROUP BY 1"""


def route_counts(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return stats.route_counts(li, "l_returnflag", "l_linestatus")


ROUTE_COUNTS_SQL = """
SELECT l_returnflag, l_linestatus, count(*) AS count FROM lineitem GROUP BY 1, 2"""


def route_top20(spark, sf_dir):
    """Top 20 (part, supplier) pairs by count desc, then keys."""
    li = _t(spark, sf_dir, "lineitem")
    return stats.route_counts(li, "l_partkey", "l_suppkey", top=20)


ROUTE_TOP20_SQL = """
SELECT l_partkey, l_suppkey, count(*) AS count FROM lineitem GROUP BY 1, 2
ORDER BY count DESC, l_partkey, l_suppkey LIMIT 20"""


def global_stats(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return stats.summary(li, "l_quantity", prefix="qty_")


GLOBAL_STATS_SQL = """
SELECT min(l_quantity) AS qty_min, max(l_quantity) AS qty_max, avg(l_quantity) AS qty_avg,
       sum(l_quantity) AS qty_sum FROM lineitem"""


def cube_count(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return stats.cube_count(li, "l_returnflag", "l_linestatus")


CUBE_COUNT_SQL = """
SELECT l_returnflag, l_linestatus, count(*) AS count FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)"""


def cube_multi(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return stats.cube_agg(li, ["l_returnflag", "l_linestatus"], {
        "count": F.count(F.lit(1)),
        "avg_qty": F.avg("l_quantity"),
        "avg_price": F.round(F.avg("l_extendedprice"), 2),
    }, order_by="avg_price")


CUBE_MULTI_SQL = """
SELECT l_returnflag, l_linestatus, count(*) AS count, avg(l_quantity) AS avg_qty,
       round(avg(l_extendedprice), 2) AS avg_price
FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)"""


def cube_lattice(spark, sf_dir):
    """Cube over three keys, one of them many-valued, from one aggregate of the rows."""
    li = _t(spark, sf_dir, "lineitem")
    return stats.cube_lattice(li, ["l_suppkey", "l_returnflag", "l_linestatus"], {
        "count": stats.rows_measure(), "sum_qty": stats.sum_measure("l_quantity"), "avg_qty": stats.avg_measure("l_quantity"),
        "first_ship": stats.min_measure("l_shipdate"), "last_ship": stats.max_measure("l_shipdate")})


CUBE_LATTICE_SQL = """
SELECT l_suppkey, l_returnflag, l_linestatus, count(*) AS count, sum(l_quantity) AS sum_qty, avg(l_quantity) AS avg_qty,
       min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
FROM lineitem GROUP BY CUBE (l_suppkey, l_returnflag, l_linestatus)"""


# --------------------------------------------------------------------------
# Sorts with the place of each row as a column (a file or table has no order to check)
# --------------------------------------------------------------------------

def order_months(spark, sf_dir):
    """Months of cancelled flights in order."""
    return with_positions(cancelled_by_month(spark, sf_dir), ["month"])


ORDER_MONTHS_SQL = f"SELECT *, row_number() OVER (ORDER BY month) - 1 AS position FROM ({CANCELLED_SQL})"


def order_json_rows(spark, sf_dir):
    """Parsed and filtered JSON rows by two keys descending (G4); equal ones by id."""
    return with_positions(json_parse_filter(spark, sf_dir), [F.col("k").desc(), F.col("value").desc(), "event_id"])


def order_ratios(spark, sf_dir):
    """Rounded ratios descending (G5); equal ones by key."""
    return with_positions(ratio_round(spark, sf_dir), [F.col("ratio").desc(), "p_partkey"])


def order_cube(spark, sf_dir):
    """Cube rows by an aggregate descending (G6); equal ones by their keys, rolled-up ones first."""
    return with_positions(cube_lattice(spark, sf_dir), [F.col("avg_qty").desc(), "l_suppkey", "l_returnflag", "l_linestatus", "count"])


ORDER_CUBE_SQL = f"""SELECT *, row_number() OVER (ORDER BY avg_qty DESC NULLS LAST, l_suppkey NULLS FIRST, l_returnflag NULLS FIRST,
    l_linestatus NULLS FIRST, count) - 1 AS position FROM ({CUBE_LATTICE_SQL})"""


# --------------------------------------------------------------------------
# JSON
# --------------------------------------------------------------------------

def json_extract(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return jsonops.extract_fields(ev, "props", {"k": "$.k"}, keep=("event_id",))


JSON_EXTRACT_SQL = "SELECT event_id, props->>'$.k' AS k FROM events"


def json_parse_filter(spark, sf_dir):
    """from_json, star-expand, conjunctive + equality filter, two-key sort
    (I13, C3, C4, C8, G4)."""
    ev = _t(spark, sf_dir, "events")
    p = jsonops.parse_column(ev, "props", "k bigint", "p", keep=("event_id", "user_id", "event_type", "value"))
    x = jsonops.expand(p, "p", keep=("event_id", "user_id", "event_type", "value"))
    return (x.filter((F.col("k") > 10) & (F.col("value") > 15))
             .where(F.col("event_type") == "view")
             .orderBy(F.col("k").desc(), F.col("value").desc()))


JSON_PARSE_FILTER_SQL = """
SELECT event_id, user_id, event_type, value, TRY_CAST(props->>'$.k' AS BIGINT) AS k
FROM events WHERE TRY_CAST(props->>'$.k' AS BIGINT) > 10 AND value > 15 AND event_type = 'view'"""


ORDER_JSON_SQL = f"SELECT *, row_number() OVER (ORDER BY k DESC, value DESC, event_id) - 1 AS position FROM ({JSON_PARSE_FILTER_SQL})"


def json_serialise(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "props")
    return jsonops.serialise(ev, alias="json")


JSON_SERIALISE_SQL = """
SELECT to_json(struct_pack(event_id := event_id, user_id := user_id, event_type := event_type,
                           props := props))::VARCHAR AS json FROM events"""


def cast_expr(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("props").alias("device"))
    return devices.cast_columns(ev)


CAST_EXPR_SQL = "SELECT TRY_CAST(event_id AS INTEGER) AS id, props AS device FROM events"


def ratio_round(spark, sf_dir):
    """round(price / size, 2) half-up on the exact quotient, descending."""
    p = _t(spark, sf_dir, "part")
    return (p.select("p_partkey", exact_round_ratio("p_retailprice", "p_size", 2, 2).alias("ratio"))
             .orderBy(F.col("ratio").desc()))


RATIO_ROUND_SQL = """
SELECT p_partkey, floor(round(p_retailprice * 100) / nullif(p_size, 0) + 0.5) / 100 AS ratio FROM part"""


ORDER_RATIOS_SQL = f"SELECT *, row_number() OVER (ORDER BY ratio DESC NULLS LAST, p_partkey) - 1 AS position FROM ({RATIO_ROUND_SQL})"


def map_explode(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    m = jsonops.parse_column(ev, "props", "map<string,bigint>", "m", keep=("event_id",))
    return jsonops.explode_map(m, "m", keep=("event_id",))


MAP_EXPLODE_SQL = """
SELECT event_id, key, TRY_CAST(json_extract_string(props, '$."' || key || '"') AS BIGINT) AS value
FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events)"""


def _datacenter_json(spark, sf_dir) -> DataFrame:
    """One data-center document per nation: a map with one device struct;
    region 0 devices carry no ``geo``."""
    n = _t(spark, sf_dir, "nation")
    r = _t(spark, sf_dir, "region")
    j = n.join(r, n["n_regionkey"] == r["r_regionkey"])
    geo = F.when(F.col("n_regionkey") != 0, F.struct(
        (F.col("n_nationkey") * F.lit(1.5)).alias("lat"),
        (F.col("n_regionkey") * F.lit(-2.25)).alias("long")))
    dev = F.struct(F.concat(F.lit("Sensor of "), F.col("n_name")).alias("description"),
                   F.concat(F.lit("10.0.0."), F.col("n_nationkey").cast("string")).alias("ip"),
                   F.col("n_nationkey").cast("long").alias("id"),
                   F.col("n_regionkey").cast("long").alias("temp"),
                   F.lit(400).cast("long").alias("c02_level"),
                   geo.alias("geo"))
    doc = F.struct(F.col("r_name").alias("dc_id"), F.create_map(F.col("n_name"), dev).alias("source"))
    return j.select(F.to_json(doc).alias("value"))


def nested_get(spark, sf_dir):
    """JSON with a map of structs: parse, explode, nested access."""
    docs = _datacenter_json(spark, sf_dir)
    dc = docs.select(F.from_json("value", schemas.DATACENTER).alias("d")).select("d.*")
    return devices.datacenter_devices(dc)


NESTED_GET_SQL = """
SELECT r_name AS id, n_name AS deviceType, 'Sensor of ' || n_name AS description,
       CASE WHEN n_regionkey = 0 THEN NULL ELSE CAST(n_nationkey AS DOUBLE) * 1.5 END AS lat
FROM nation JOIN region ON n_regionkey = r_regionkey"""


# --------------------------------------------------------------------------
# The jobs over files
# --------------------------------------------------------------------------

# Hosts that the lines of the visit log name in turn; two of them have no label.
LOG_HOSTS = ["www.baidu.com", "www.ali.com", "jd.com", "shop.example.org", "youku.com", "jd.com:8080", "user@youku.com", "blog.example.net"]
LOG_FILES = 16


def _visit_files(spark, sf_dir) -> tuple[str, str]:
    """Paths of ``events`` as pipe lines, in one folder ``part=n`` for each of ``LOG_FILES``, in
    event order, and of customer labels."""
    ev = _t(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    kind = F.when(F.col("event_type") == "view", F.lit("pageview")).otherwise(F.col("event_type"))
    host = F.element_at(F.array(*map(F.lit, LOG_HOSTS)), (F.col("event_id") % len(LOG_HOSTS) + 1).cast("int"))
    url = F.concat(F.lit("https://"), host, F.lit("/"), F.coalesce(F.get_json_object("props", "$.k"), F.lit("none")))
    line = F.concat_ws("|", kind, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.col("user_id").cast("string"),
                       F.col("event_id").cast("string"), url)
    labels = _t(spark, sf_dir, "customer").filter("c_acctbal > 0").select(
        F.concat_ws("|", F.col("c_custkey").cast("string"), "c_mktsegment").alias("value"))
    log_path, label_path = scratch_path(spark, "visit-lines"), scratch_path(spark, "label-lines")
    (ev.select((F.col("event_id") % LOG_FILES).alias("part"), "event_id", line.alias("value")).repartition(LOG_FILES, "part")
       .sortWithinPartitions("part", "event_id").select("value", "part").write.partitionBy("part").text(log_path))
    labels.write.text(label_path)
    return log_path, label_path


def visit_log_sessions(spark, sf_dir):
    """The visit-log job on text files: ``events`` and customer labels are
    written as pipe lines, read, cleaned, their times parsed, cut and labelled
    (A1, A2, B1, B2, G1, I6, I9, F1-F4, D1-D3). Times are whole seconds, so which of
    several rows comes first is told by their files and line numbers."""
    log_path, label_path = _visit_files(spark, sf_dir)
    log = read_log(spark, log_path, file_key=F.col("part")).rows
    return build_sessions(log, parse_cookie_labels(read_lines(spark, label_path)).rows)


VISIT_LOG_SQL = f"""
WITH e AS (
  SELECT date_trunc('second', ts) AS ts, user_id, event_type, event_id, event_id % {LOG_FILES} AS file,
         row_number() OVER (PARTITION BY event_id % {LOG_FILES} ORDER BY event_id) - 1 AS line,
         [{", ".join(f"'{h}'" for h in LOG_HOSTS)}][event_id % {len(LOG_HOSTS)} + 1] AS host,
         coalesce(json_extract_string(props, '$.k'), 'none') AS page FROM events),
k AS (SELECT * FROM e WHERE event_type IN ('view', 'click') AND ts IS NOT NULL AND user_id IS NOT NULL),
f AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS nw
      FROM k WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
g AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seq FROM f),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, seq ORDER BY ts, file, line) AS nth,
             row_number() OVER (PARTITION BY user_id, seq, event_type ORDER BY ts, file, line) AS nth_of_type FROM g),
s AS (SELECT user_id, seq, min(ts) AS start, CAST(count(*) FILTER (WHERE event_type = 'view') AS INTEGER) AS views,
             CAST(count(*) FILTER (WHERE event_type = 'click') AS INTEGER) AS clicks,
             max(event_id) FILTER (WHERE nth = 1) AS ip, max(file) FILTER (WHERE nth = 1) AS file, max(line) FILTER (WHERE nth = 1) AS line,
             max('https://' || host || '/' || page) FILTER (WHERE nth_of_type = 1 AND event_type = 'view') AS url,
             max(split_part(split_part(host, '@', -1), ':', 1)) FILTER (WHERE nth_of_type = 1 AND event_type = 'view') AS host
      FROM r GROUP BY user_id, seq)
SELECT sha256(concat_ws('|', CAST(s.user_id AS VARCHAR), strftime(start, '%Y-%m-%d %H:%M:%S.%f'), '{{' || file || ', ' || line || '}}')) AS session_id,
       strftime(start, '%Y-%m-%d %H:%M:%S') AS session_server_time, CAST(s.user_id AS VARCHAR) AS cookie,
       coalesce(c.c_mktsegment, '-') AS cookie_label, CAST(ip AS VARCHAR) AS ip, coalesce(url, '-') AS landing_url,
       views AS pageview_count, clicks AS click_count, coalesce(host, '-') AS domain, coalesce(d.label, '-') AS domain_label
FROM s LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON c.c_custkey = s.user_id
LEFT JOIN (VALUES {_sql_values(DOMAIN_LABELS)}) d(host_name, label) ON d.host_name = s.host"""


def flight_file_reports(spark, sf_dir):
    """Month counts and the cube over nested columns, from a flight file that is
    written as text and parsed (A3, B3, E5, E9, C9)."""
    path = scratch_path(spark, "flight-lines")
    _flight_lines(spark, sf_dir).write.text(path)
    parsed = scratch_path(spark, "flights")  # parsed once for both reports, which need few fields
    parse_flights(read_lines(spark, path)).rows.select(
        F.struct("date.month").alias("date"), F.struct("times.actualElapsedTime").alias("times"), "origin", "dest", "distance", "canceled").write.parquet(parsed)
    rows = spark.read.parquet(parsed)
    cube = flights.route_cube(rows).select(F.lit("cube").alias("report"), "origin", "dest", F.lit(None).cast("int").alias("month"),
                                           "count", "avg_elapsed", "avg_distance")
    months = stats.cancelled_by_month(rows).toDF("month", "count").select(
        F.lit("months").alias("report"), F.lit(None).cast("string").alias("origin"), F.lit(None).cast("string").alias("dest"), "month", "count",
        F.lit(None).cast("double").alias("avg_elapsed"), F.lit(None).cast("double").alias("avg_distance"))
    return cube.unionByName(months)


FLIGHT_FILE_SQL = """
WITH f AS (SELECT l_returnflag AS origin, l_linestatus AS dest, CAST(month(l_shipdate) AS INTEGER) AS month, l_partkey,
                  CAST(floor(l_extendedprice) AS INTEGER) AS distance FROM lineitem WHERE l_returnflag <> 'R')
SELECT 'cube' AS report, origin, dest, CAST(NULL AS INTEGER) AS month, count(*) AS count, avg(l_partkey) AS avg_elapsed, avg(distance) AS avg_distance
FROM f GROUP BY CUBE (origin, dest)
UNION ALL
SELECT 'months', NULL, NULL, month, count(*), NULL, NULL FROM f WHERE dest = 'F' GROUP BY month"""


def airport_file_rows(spark, sf_dir):
    """An airport file, written as text and read."""
    path = scratch_path(spark, "airport-lines")
    _airport_lines(spark, sf_dir).write.text(path)
    return flights.load_airports(spark, path).rows


def id_json_file_reports(spark, sf_dir):
    """A file of ``id::json`` lines, written as text, read and its JSON taken apart."""
    path = scratch_path(spark, "device-lines")
    ev = _t(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    payload = F.to_json(F.struct(F.col("event_id").alias("device_id"), F.col("event_type").alias("device_type"), F.lit("USA").alias("cca3"),
                                 F.pmod("event_id", F.lit(40)).alias("temp"), F.pmod("user_id", F.lit(30)).alias("signal"),
                                 (F.col("event_id") + 100).alias("c02_level")))
    ev.select(F.concat(F.col("event_id").cast("string"), F.lit("::"), payload).alias("value")).write.text(path)
    rows = devices.active_devices(devices.load_devices(spark, path).rows)
    return rows.select("device_id", "device_type", "cca3", "temp", "signal", "c02_level")


ID_JSON_FILE_SQL = """
SELECT event_id AS device_id, event_type AS device_type, 'USA' AS cca3, event_id % 40 AS temp, user_id % 30 AS signal, event_id + 100 AS c02_level
FROM events WHERE event_id % 40 > 10 AND user_id % 30 > 15"""


def _route_lines(spark, sf_dir) -> DataFrame:
    """Lineitems as flight lines between nations' airports."""
    names = lambda end: _t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias(f"{end}_key"), F.col("n_name").alias(end))
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice")
    li = (li.join(names("origin"), F.col("l_suppkey") % 25 == F.col("origin_key")).join(names("dest"), F.col("l_partkey") % 25 == F.col("dest_key")))
    fields = [F.lit("2024")] * 8 + [F.lit("WX"), F.col("l_orderkey").cast("string"), F.lit("T1")] + [F.col("l_linenumber").cast("string")] * 5 + [
        F.col("origin"), F.col("dest"), F.floor("l_extendedprice").cast("int").cast("string")] + [F.lit("0")] * 10
    return _with_header(spark, li.select(F.concat_ws(",", *fields).alias("value")), FLIGHT_HEADER)


def flight_airports(spark, sf_dir):
    """A flight file and an airport file, read and joined by origin and by destination."""
    paths = {name: scratch_path(spark, f"{name}-lines") for name in ("route", "airport")}
    _route_lines(spark, sf_dir).write.text(paths["route"])
    _airport_lines(spark, sf_dir).write.text(paths["airport"])
    rows = parse_flights(read_lines(spark, paths["route"])).rows.select("flightNum", F.col("times.airTime").alias("airTime"), "origin", "dest", "distance")
    return flights.with_airports(rows, flights.load_airports(spark, paths["airport"]).rows, ("airport", "city", "lat"))


FLIGHT_AIRPORTS_SQL = f"""
WITH a AS ({PARSE_QUOTED_SQL})
SELECT CAST(l_orderkey AS INTEGER) AS flightNum, CAST(l_linenumber AS INTEGER) AS airTime, o.n_name AS origin, d.n_name AS dest,
       CAST(floor(l_extendedprice) AS INTEGER) AS distance, x.airport AS origin_airport, x.city AS origin_city, x.lat AS origin_lat,
       y.airport AS dest_airport, y.city AS dest_city, y.lat AS dest_lat
FROM lineitem JOIN nation o ON l_suppkey % 25 = o.n_nationkey JOIN nation d ON l_partkey % 25 = d.n_nationkey
LEFT JOIN a x ON x.iata = o.n_name LEFT JOIN a y ON y.iata = d.n_name"""


def json_file_nested(spark, sf_dir):
    """Nested documents written as JSON lines and read with a declared schema,
    with integer epochs read as timestamps (A6, A11, I13, I17, I18)."""
    path = scratch_path(spark, "datacenters")
    _datacenter_json(spark, sf_dir).write.text(path)
    dc = devices.datacenter_devices(read_json(spark, path, schemas.DATACENTER))
    times = F.from_json(F.concat(F.lit('{"timestamp": '), (F.length("description") * 86400).cast("string"), F.lit("}")), "timestamp timestamp")
    return dc.select("*", F.unix_seconds(times["timestamp"]).alias("epoch"))


JSON_FILE_SQL = """
SELECT r_name AS id, n_name AS deviceType, 'Sensor of ' || n_name AS description,
       CASE WHEN n_regionkey = 0 THEN NULL ELSE CAST(n_nationkey AS DOUBLE) * 1.5 END AS lat,
       CAST(length('Sensor of ' || n_name) * 86400 AS BIGINT) AS epoch
FROM nation JOIN region ON n_regionkey = r_regionkey"""


# --------------------------------------------------------------------------
# Sources and sinks round trips (write under the shared checkpoint folder)
# --------------------------------------------------------------------------

_LI_COLS = ["l_orderkey", "l_linenumber", "l_returnflag", "l_quantity"]
# Inference finds the narrowest of int, long and double; the columns are returned as inferred.
_LI_SQL = """SELECT CAST(l_orderkey AS INTEGER) AS l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber, l_returnflag,
       CAST(l_quantity AS DOUBLE) AS l_quantity FROM lineitem"""


def csv_infer_header(spark, sf_dir):
    """CSV with header, read back with types that are inferred as the rows pass."""
    path = scratch_path(spark, "csv-header")
    write_csv(_t(spark, sf_dir, "lineitem").select(*_LI_COLS), path, header=True)
    return infer_csv(spark, path, scratch_path(spark, "csv-typed"), header=True)


def csv_infer_noheader(spark, sf_dir):
    """Header-less CSV with inferred types, read back."""
    path = scratch_path(spark, "csv-plain")
    write_csv(_t(spark, sf_dir, "lineitem").select(*_LI_COLS), path, header=False)
    return infer_csv(spark, path, scratch_path(spark, "csv-typed")).toDF(*_LI_COLS)


def text_sink_roundtrip(spark, sf_dir):
    """Sessions written as ``(null,<json>)`` lines and read back."""
    path = scratch_path(spark, "text-sink")
    s = _core_sessions(spark, sf_dir, "gap").select("user_id", "session_start", "pageview_count", "click_count")
    write_text(s, path)
    return read_text_records(spark, path, s.schema)


TEXT_SINK_SQL = f"""
WITH e AS (SELECT * FROM events WHERE event_type IN ('view', 'click') AND ts IS NOT NULL AND user_id IS NOT NULL),
f AS (SELECT *, {GAP_CUT_SQL} AS nw FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
g AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY ts, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seq FROM f)
SELECT user_id, min(ts) AS session_start,
       CAST(count(*) FILTER (WHERE event_type = 'view') AS INTEGER) AS pageview_count,
       CAST(count(*) FILTER (WHERE event_type = 'click') AS INTEGER) AS click_count
FROM g GROUP BY user_id, seq"""


def parquet_sink_roundtrip(spark, sf_dir):
    """Route counts written as Parquet and read back (L2, L3)."""
    path = scratch_path(spark, "parquet-sink")
    write_parquet(route_counts(spark, sf_dir), path)
    return spark.read.parquet(path)


# --------------------------------------------------------------------------
# Streaming form of gap sessions (bounded catch-up run over ``events``)
# --------------------------------------------------------------------------

def _events_stream(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """``events`` as a table and as a stream of its files."""
    from weft.streaming import sessions as streaming

    events = _t(spark, sf_dir, "events")
    # a table is one file, which the file source takes by its name in the folder, or a folder of part files
    if any(f.rsplit("/", 1)[0].endswith("/events.parquet") for f in events.inputFiles()):
        return events, streaming.file_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet", events.schema)
    return events, streaming.file_stream(spark, sf_dir.rstrip("/"), events.schema, glob="events.parquet")


def streaming_gap_sessions(spark, sf_dir):
    """Gap sessions computed by a Structured Streaming query in append mode
    (watermark + session window, state on disk and in the checkpoint folder),
    run to completion over the available ``events`` and an end mark that closes
    the last sessions, then read back."""
    from weft.streaming import sessions as streaming

    events, stream = _events_stream(spark, sf_dir)
    spec = SessionSpec(user="user_id", ts="ts", order="event_id", kind="event_type",
                       pageview="view", click="click", first=("value",))
    out, ck, end = (scratch_path(spark, f"stream-{x}") for x in ("out", "ck", "end"))
    streaming.write_end_mark(events, spec, end)
    stream = stream.union(streaming.file_stream(spark, end, events.schema))
    q = streaming.write_parquet(streaming.gap_sessions(stream, spec), out, ck, mode="append",
                                available_now=True)
    q.awaitTermination()
    return spark.read.parquet(out)


STREAMING_GAP_SQL = f"""
WITH e AS (SELECT * FROM events WHERE event_type IN ('view', 'click') AND ts IS NOT NULL AND user_id IS NOT NULL),
f AS (SELECT *, {GAP_CUT_SQL} AS nw FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
g AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY ts, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seq FROM f)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end,
       arg_min(event_id, (ts, event_id)) AS first_order, arg_min(value, (ts, event_id)) AS "value",
       count(*) AS event_count,
       CAST(count(*) FILTER (WHERE event_type = 'view') AS INTEGER) AS pageview_count,
       CAST(count(*) FILTER (WHERE event_type = 'click') AS INTEGER) AS click_count
FROM g GROUP BY user_id, seq"""


def streaming_pageview_sessions(spark, sf_dir):
    """Page-view sessions computed by a Structured Streaming query with keyed state and timers
    (F2, F3 on streams), run to completion over ``events`` and an end mark, then read back."""
    from weft.streaming import pageviews
    from weft.streaming import sessions as streaming

    events, stream = _events_stream(spark, sf_dir)
    spec = SessionSpec(user="user_id", ts="ts", order="event_id", kind="event_type",
                       pageview="view", click="click", first=("value",), landing=("event_id",))
    out, ck, end = (scratch_path(spark, f"views-{x}") for x in ("out", "ck", "end"))
    streaming.write_end_mark(events, spec, end, after="800 days")
    stream = stream.union(streaming.file_stream(spark, end, events.schema))
    streaming.write_parquet(pageviews.pageview_sessions(stream, spec, idle="365 days"), out, ck, available_now=True).awaitTermination()
    return spark.read.parquet(out)


STREAMING_PAGEVIEW_SQL = f"""
WITH e AS (SELECT * FROM events WHERE event_type IN ('view', 'click') AND ts IS NOT NULL AND user_id IS NOT NULL),
g AS (SELECT *, sum({PAGEVIEW_CUT_SQL}) OVER (PARTITION BY user_id ORDER BY ts, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seq FROM e)
SELECT user_id, min(ts) AS session_start, arg_min(event_id, (ts, event_id)) AS first_order, arg_min(value, (ts, event_id)) AS "value",
       arg_min(event_id, (ts, event_id)) FILTER (WHERE event_type = 'view') AS landing_event_id,
       CAST(count(*) FILTER (WHERE event_type = 'view') AS INTEGER) AS pageview_count,
       CAST(count(*) FILTER (WHERE event_type = 'click') AS INTEGER) AS click_count
FROM g GROUP BY user_id, seq"""


# --------------------------------------------------------------------------

QUERIES: dict[str, Query] = {
    "gap_sessions": gap_sessions,
    "pageview_sessions": pageview_sessions,
    "gap_sessions_native": gap_sessions_native,
    "incremental_gap_sessions": incremental_gap_sessions,
    "session_count": session_count,
    "session_id_hash": session_id_hash,
    "event_type_filter": event_type_filter,
    "url_host": url_host_query,
    "domain_label": domain_label,
    "user_label_left_join": user_label_left_join,
    "label_fanout": label_fanout,
    "parse_pipe_line": parse_pipe_line,
    "parse_id_payload": parse_id_payload_query,
    "parse_wide_csv": parse_wide_csv,
    "flight_elapsed_summary": flight_elapsed_summary,
    "lenient_int": lenient_int_query,
    "parse_quoted_regex": parse_quoted_regex,
    "rejects": rejects,
    "cancelled_by_month": cancelled_by_month,
    "route_counts": route_counts,
    "route_top20": route_top20,
    "global_stats": global_stats,
    "cube_count": cube_count,
    "cube_multi": cube_multi,
    "cube_lattice": cube_lattice,
    "order_months": order_months,
    "order_json_rows": order_json_rows,
    "order_ratios": order_ratios,
    "order_cube": order_cube,
    "json_extract": json_extract,
    "json_parse_filter": json_parse_filter,
    "json_serialise": json_serialise,
    "cast_expr": cast_expr,
    "ratio_round": ratio_round,
    "map_explode": map_explode,
    "nested_get": nested_get,
    "visit_log_sessions": visit_log_sessions,
    "flight_file_reports": flight_file_reports,
    "airport_file_rows": airport_file_rows,
    "id_json_file_reports": id_json_file_reports,
    "flight_airports": flight_airports,
    "json_file_nested": json_file_nested,
    "csv_infer_header": csv_infer_header,
    "csv_infer_noheader": csv_infer_noheader,
    "text_sink_roundtrip": text_sink_roundtrip,
    "parquet_sink_roundtrip": parquet_sink_roundtrip,
    "streaming_gap_sessions": streaming_gap_sessions,
    "streaming_pageview_sessions": streaming_pageview_sessions,
}

ORACLES: dict[str, str] = {
    "gap_sessions": _sessions_sql(GAP_CUT_SQL),
    "pageview_sessions": _sessions_sql(PAGEVIEW_CUT_SQL),
    "gap_sessions_native": GAP_NATIVE_SQL,
    "incremental_gap_sessions": INCREMENTAL_SQL,
    "session_count": SESSION_COUNT_SQL,
    "session_id_hash": SESSION_ID_HASH_SQL,
    "event_type_filter": "SELECT event_id, user_id, event_type FROM events WHERE event_type IN ('view', 'click')",
    "url_host": URL_HOST_QUERY_SQL,
    "domain_label": DOMAIN_LABEL_SQL,
    "user_label_left_join": USER_LABEL_SQL,
    "label_fanout": LABEL_FANOUT_SQL,
    "parse_pipe_line": PARSE_PIPE_SQL,
    "parse_id_payload": PARSE_ID_PAYLOAD_SQL,
    "parse_wide_csv": PARSE_WIDE_CSV_SQL,
    "flight_elapsed_summary": FLIGHT_ELAPSED_SQL,
    "lenient_int": LENIENT_INT_SQL,
    "parse_quoted_regex": PARSE_QUOTED_SQL,
    "rejects": REJECTS_SQL,
    "cancelled_by_month": CANCELLED_SQL,
    "route_counts": ROUTE_COUNTS_SQL,
    "route_top20": ROUTE_TOP20_SQL,
    "global_stats": GLOBAL_STATS_SQL,
    "cube_count": CUBE_COUNT_SQL,
    "cube_multi": CUBE_MULTI_SQL,
    "cube_lattice": CUBE_LATTICE_SQL,
    "order_months": ORDER_MONTHS_SQL,
    "order_json_rows": ORDER_JSON_SQL,
    "order_ratios": ORDER_RATIOS_SQL,
    "order_cube": ORDER_CUBE_SQL,
    "json_extract": JSON_EXTRACT_SQL,
    "json_parse_filter": JSON_PARSE_FILTER_SQL,
    "json_serialise": JSON_SERIALISE_SQL,
    "cast_expr": CAST_EXPR_SQL,
    "ratio_round": RATIO_ROUND_SQL,
    "map_explode": MAP_EXPLODE_SQL,
    "nested_get": NESTED_GET_SQL,
    "visit_log_sessions": VISIT_LOG_SQL,
    "flight_file_reports": FLIGHT_FILE_SQL,
    "airport_file_rows": PARSE_QUOTED_SQL,
    "id_json_file_reports": ID_JSON_FILE_SQL,
    "flight_airports": FLIGHT_AIRPORTS_SQL,
    "json_file_nested": JSON_FILE_SQL,
    "csv_infer_header": _LI_SQL,
    "csv_infer_noheader": _LI_SQL,
    "text_sink_roundtrip": TEXT_SINK_SQL,
    "parquet_sink_roundtrip": ROUTE_COUNTS_SQL,
    "streaming_gap_sessions": STREAMING_GAP_SQL,
    "streaming_pageview_sessions": STREAMING_PAGEVIEW_SQL,
}
