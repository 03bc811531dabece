"""Visit log -> cleaned log + one row per session (the visit-log job).

Plan: scan lines -> parse columns -> type filter (pushed before the cut) ->
session cut (skew-safe, see ``operators.sessions``) -> host + domain label
(literal map, no join) -> cookie label (salted left join, broadcast only when the
label side is small) -> sinks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from weft import schemas
from weft.functions.columns import MISSING_STRING, parse_log_time, url_host
from weft.operators.labels import DOMAIN_LABELS, map_lookup, salted_left_join
from weft.operators.sessions import (CLICK, DEFAULT_GAP, PAGEVIEW, SessionSpec, cut_sessions,
                                     unusable_rows, with_session_id)
from weft.session import scratch_path
from weft.sinks.commits import Commits
from weft.sinks.writers import select_sink
from weft.sources.formats import LINE, Parsed, parse_cookie_labels, parse_visit_log, read_lines

# Log types kept by the job.
LOG_TYPES = (PAGEVIEW, CLICK)
# Settings that name the job's paths.
LOG_PATH_KEY = "spark.weft.visits.logPath"
LABEL_PATH_KEY = "spark.weft.visits.labelPath"
OUTPUT_PATH_KEY = "spark.weft.visits.outputPath"


def clean_log(lines: DataFrame, types: tuple[str, ...] = LOG_TYPES) -> Parsed:
    """Parse visit-log lines and keep only the given log types.

    Rows of a kept type whose time does not parse become rejects
    (``bad_time``, the whole line); rows of other types are dropped, not
    rejected. The result can be ``persist()``-ed or ``written()`` as one
    staged projection.
    """
    def typed_step(rows: DataFrame, rejects: DataFrame) -> tuple[DataFrame, DataFrame]:
        typed = rows.filter(F.col("log_type").isin(*types)).withColumn(
            "ts", parse_log_time("log_server_time"))
        bad_time = typed.filter(F.col("ts").isNull()).select(F.col(LINE).alias("value"), F.lit("bad_time").alias("reason"))
        return typed.filter(F.col("ts").isNotNull()).drop(LINE), rejects.unionByName(bad_time)

    return parse_visit_log(lines, keep_line=True).derive(typed_step)


def read_log(spark: SparkSession, path: str | list[str], file_key: Column | None = None) -> Parsed:
    """The cleaned log of text files, ``log_order`` = (file, line): equal at any size of
    the input splits, and unchanged by files that are added. The lines are read once and
    their parse written to the checkpoint folder."""
    lines = read_lines(spark, path, places=True, file_key=file_key)
    return clean_log(lines).written(scratch_path(spark, "visit-log")).numbered("log_order")


def log_spec(first: tuple[str, ...] = ("ip", "log_server_time")) -> SessionSpec:
    return SessionSpec(user="cookie", ts="ts", order="log_order", kind="log_type",
                       pageview=PAGEVIEW, click=CLICK, first=first, landing=("url",))


def label_domains(sessions: DataFrame, url_col: str = "landing_url",
                  domain_labels: Mapping[str, str] | DataFrame = DOMAIN_LABELS) -> DataFrame:
    """Landing URL / host / domain label with ``-`` defaults.

    Host is taken only from a real landing URL; the label is an exact host
    match. A literal mapping is a map literal in the projection; a DataFrame
    dimension goes through the size-checked join.
    """
    has_url = F.col(url_col).isNotNull()
    s = (sessions.withColumn(url_col, F.coalesce(F.col(url_col), F.lit(MISSING_STRING)))
                 .withColumn("domain", F.when(has_url, url_host(url_col))
                                        .otherwise(F.lit(MISSING_STRING))))
    if isinstance(domain_labels, DataFrame):
        from weft.operators.labels import attach_unique_label
        return attach_unique_label(s, domain_labels, "domain", "domain_label")
    return s.withColumn("domain_label", map_lookup("domain", domain_labels))


def build_sessions(log: DataFrame, cookie_labels: DataFrame | None,
                   domain_labels: Mapping[str, str] | DataFrame = DOMAIN_LABELS,
                   strategy: str = "gap", gap: str | int = DEFAULT_GAP,
                   random_ids: bool = False) -> DataFrame:
    """Cleaned log -> tracker sessions in the reference's session schema
    (F1-F4, E2-E4, D1-D3, I8, I9)."""
    s = cut_sessions(log, log_spec(), strategy=strategy, gap=gap)
    s = with_session_id(s, "cookie", random=random_ids)
    s = label_domains(s, "landing_url", domain_labels)
    if cookie_labels is not None:
        s = salted_left_join(s, cookie_labels, "cookie", "cookie_label")
    else:
        s = s.withColumn("cookie_label", F.lit(MISSING_STRING))
    return s.select(
        "session_id",
        F.col("log_server_time").alias("session_server_time"),
        "cookie", "cookie_label", "ip", "landing_url",
        "pageview_count", "click_count", "domain", "domain_label")


def run_visit_job(spark: SparkSession, visit_log_path: str | None = None,
                  cookie_label_path: str | None = None, output_path: str | None = None,
                  sink: str = "text", strategy: str = "gap", gap: str | int = DEFAULT_GAP,
                  domain_labels: Mapping[str, str] = DOMAIN_LABELS,
                  random_ids: bool = False, together: bool = False) -> dict:
    """The whole job: read, clean, cut, label, write ``trackerLog``,
    ``trackerSession`` and ``rejects`` under ``output_path``.

    ``together`` makes the three outputs visible at once: they go to a folder of this run
    and are committed after the last (``weft.sinks.commits``); readers ask
    ``Commits(spark, output_path).read(name)`` and see the run before until then. Without
    it each output replaces its own folder as it is written.

    Paths not given are read from the ``spark.weft.visits.*`` settings (A12).
    Returns counts gathered with ``observe`` (E10), which are exact under task
    retries, unlike an accumulator.
    """
    def path(given: str | None, key: str) -> str:
        found = given or spark.conf.get(key, None)
        if not found:
            raise ValueError(f"no path: give one or set {key}")
        return found

    visit_log_path, cookie_label_path = path(visit_log_path, LOG_PATH_KEY), path(cookie_label_path, LABEL_PATH_KEY)
    output_path = path(output_path, OUTPUT_PATH_KEY).rstrip("/")
    run = Commits(spark, output_path).begin() if together else None
    place = run.path if run else lambda name: f"{output_path}/{name}"
    write = select_sink(sink)

    # One pass over the raw log: the cleaned log, the sessions and the rejects
    # come from the written copy of its parse.
    parsed = read_log(spark, visit_log_path)
    log = parsed.rows
    labels = parse_cookie_labels(read_lines(spark, cookie_label_path))
    log_obs = Observation("log")
    log_out = log.select(*schemas.TRACKER_LOG.fieldNames()).observe(
        log_obs, F.count(F.lit(1)).alias("log_rows"))
    write(log_out, place("trackerLog"))

    sess_obs = Observation("sessions")
    sessions = build_sessions(log, labels.rows, domain_labels, strategy, gap, random_ids)
    sessions = sessions.observe(sess_obs, F.count(F.lit(1)).alias("session_count"))
    write(sessions, place("trackerSession"))

    rej_obs = Observation("rejects")
    unusable = unusable_rows(log, log_spec()).select(
        F.concat_ws("|", *schemas.TRACKER_LOG.fieldNames()).alias("value"), "reason")
    rejects = parsed.rejects.unionByName(unusable).unionByName(labels.rejects).observe(
        rej_obs, F.count(F.lit(1)).alias("reject_count"))
    rejects.write.mode("overwrite").parquet(place("rejects"))
    counts = {**log_obs.get, **sess_obs.get, **rej_obs.get}
    return {**counts, "generation": run.commit(**counts).number} if run else counts
