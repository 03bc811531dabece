"""Gap sessions on a stream: watermark + ``session_window``.

The same cut as the batch gap strategy (a new session after more than
``gap`` of inactivity; exactly ``gap`` stays in the session), kept as
streaming state per visitor. Order-dependent fields (first row, landing page)
are ``min`` aggregates over (time, id) structs, so they need no ordering of
the stream. Sessions are merged inside each input partition before the
shuffle (``merge.sessions.in.local.partition``), so a visitor with many
events sends a few partial sessions per partition, not every event.

Output modes: ``append`` emits a session once the watermark has passed its
end and then drops its state (bounded state: use it for unbounded streams);
``complete`` re-emits every session each trigger (state grows with the
data: only for bounded inputs, e.g. an ``availableNow`` catch-up run).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from weft.functions.columns import epoch_micros
from weft.operators.sessions import DEFAULT_GAP, SessionSpec

# Session settings the stream is started with (and left as they were after):
# partial sessions merge inside a partition, and state lives on disk.
STREAM_SETTINGS = {
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def file_stream(spark: SparkSession, directory: str, schema: T.StructType, fmt: str = "parquet",
                glob: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """A file-source stream over ``directory`` (new files become new data)."""
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(directory)


def gap_sessions(stream: DataFrame, spec: SessionSpec, gap: str = DEFAULT_GAP,
                 watermark: str = "1 hour") -> DataFrame:
    """Streaming gap sessions; one row per (visitor, session window).

    Rows without a visitor or a time are left out, as in the batch form.
    ``watermark`` is how late a row may come: in append mode a row that is
    later than that behind the latest time of earlier micro-batches is
    dropped by the state operator and counted (``late_rows``). Choose it for the source."""
    kinds = F.col(spec.kind)
    ts_type = stream.schema[spec.ts].dataType
    # the zone-free time as microseconds since the epoch: no session time zone is involved
    ev = (stream.filter(kinds.isin(spec.pageview, spec.click) & F.col(spec.user).isNotNull() & F.col(spec.ts).isNotNull())
                .withColumn("_et", F.timestamp_micros(epoch_micros(spec.ts, ts_type)))
                .withWatermark("_et", watermark))
    order = F.struct(F.col("_et"), F.col(spec.order))
    first = F.struct(F.col("_et"), F.col(spec.order), *[F.col(c) for c in spec.first])
    land = F.struct(F.col("_et"), F.col(spec.order), *[F.col(c) for c in spec.landing])
    agg = (ev.groupBy(F.col(spec.user), F.session_window("_et", gap).alias("_w"))
             .agg(F.count(F.lit(1)).alias("event_count"),
                  F.count_if(kinds == spec.pageview).cast("int").alias("pageview_count"),
                  F.count_if(kinds == spec.click).cast("int").alias("click_count"),
                  F.min_by(F.col(spec.order), order).alias("first_order"),
                  F.min(first).alias("_first"),
                  F.min(F.when(kinds == spec.pageview, land)).alias("_land")))
    def zone_free(end: Column) -> Column:
        if not isinstance(ts_type, T.TimestampNTZType):
            return end
        micros = F.unix_micros(end)
        return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))

    return agg.select(
        spec.user,
        zone_free(F.col("_w.start")).alias("session_start"),
        zone_free(F.col("_w.end")).alias("session_end"),
        "first_order",
        *[F.col(f"_first.{c}").alias(c) for c in spec.first],
        *[F.col(f"_land.{c}").alias(f"landing_{c}") for c in spec.landing],
        "event_count", "pageview_count", "click_count")


def write_end_mark(events: DataFrame, spec: SessionSpec, path: str, after: str = "2 days") -> None:
    """One row of the events' schema, of no visitor's, ``after`` beyond their last
    time, as Parquet. A bounded append run that reads it beside the events has
    its watermark pass every session's end, so all of them are closed and written;
    the mark's own session stays open and is not."""
    kinds = {f.name: f.dataType for f in events.schema.fields}
    mark = {spec.user: F.lit(-1 if not isinstance(kinds[spec.user], T.StringType) else "").cast(kinds[spec.user]),
            spec.kind: F.lit(spec.click).cast(kinds[spec.kind]), spec.ts: F.col("_last")}
    last = events.agg((F.max(spec.ts) + F.expr(f"INTERVAL {after}")).alias("_last"))
    last.select(*[mark.get(n, F.lit(None).cast(t)).alias(n) for n, t in kinds.items()]).write.mode("overwrite").parquet(path)


def write_parquet(sessions: DataFrame, output: str, checkpoint: str, mode: str = "append",
                  available_now: bool = False, processing_time: str | None = None) -> StreamingQuery:
    """Run the stream into Parquet. ``append`` adds closed sessions;
    ``complete`` replaces the folder with the full result each trigger. The
    checkpoint makes the query restartable after a failure (exactly-once
    file output for append through the file sink's log)."""
    spark = sessions.sparkSession
    before = {k: spark.conf.get(k, None) for k in STREAM_SETTINGS}
    for k, v in STREAM_SETTINGS.items():
        spark.conf.set(k, v)
    try:
        return _start(sessions, output, checkpoint, mode, available_now, processing_time)
    finally:  # a started query keeps the settings it began with
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def late_rows(query: StreamingQuery) -> int:
    """Rows that the state operators dropped as later than the watermark."""
    return sum(int(op.numRowsDroppedByWatermark) for p in query.recentProgress for op in p.stateOperators)


def _start(sessions: DataFrame, output: str, checkpoint: str, mode: str, available_now: bool,
           processing_time: str | None) -> StreamingQuery:
    if mode == "append":
        w = (sessions.writeStream.outputMode("append").format("parquet")
             .option("path", output).option("checkpointLocation", checkpoint))
    elif mode == "complete":
        def replace(batch: DataFrame, _epoch: int) -> None:
            batch.write.mode("overwrite").parquet(output)
        w = (sessions.writeStream.outputMode("complete").foreachBatch(replace)
             .option("checkpointLocation", checkpoint))
    else:
        raise ValueError(f"unsupported output mode {mode!r}")
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
