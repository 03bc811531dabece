"""Session cutting (gap and page-view strategies) as distributed plans.

A session row carries: the visitor key, the first row's time and order id,
columns taken from the first row (``first``), columns taken from the first
page view (``landing``, null when the session has none), and the page-view
and click counts.

Neither strategy sends one visitor's rows to one task, so a visitor holding a
large share of all rows does not serialise the job:

* gap: rows are pre-aggregated per (visitor, time cell of one gap width).
  All rows of one cell are closer than the gap, so a cell never splits; the
  aggregate combines map-side before its shuffle. Sessions are then cut over
  the cell summaries, whose count per visitor is bounded by time span / gap,
  not by the number of rows; for small gaps in two levels, stretches of cells first.
* page view: rows are dealt once, by (visitor, time cell), and each cell is scanned
  with a window; a cell with very many rows is cut into balanced slices by a range
  exchange. The rows at the head of a cell or slice that precede its first page view
  continue the visitor's latest page view in an earlier one, which comes from a window
  over the cells' summaries.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.functions.columns import epoch_micros, floor_div, session_hash_id, ts_text
from weft.session import checkpoint_dir

# Fixed values of the reference's session cutting.
DEFAULT_GAP = "30 minutes"
PAGEVIEW = "pageview"
CLICK = "click"


@dataclass(frozen=True)
class SessionSpec:
    """Which columns play which role in session cutting."""

    user: str                       # visitor key (cookie)
    ts: str                         # event time: timestamp or timestamp_ntz
    order: str | None               # unique row id; breaks ties on equal time. None: the first
                                    # row is not asked for, so no first_order, first or landing
    kind: str                       # event-type column
    pageview: str = PAGEVIEW
    click: str = CLICK
    first: tuple[str, ...] = field(default_factory=tuple)    # from the first row
    landing: tuple[str, ...] = field(default_factory=tuple)  # from the first page view


_UNITS = {"microsecond": 1, "millisecond": 1000, "second": 1_000_000,
          "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000}


def gap_micros(gap: str | int) -> int:
    """``'30 minutes'`` / ``'1 hour'`` / minutes as int -> microseconds."""
    if isinstance(gap, int):
        micros = gap * _UNITS["minute"]
    else:
        m = re.fullmatch(r"\s*(\d+)\s*([a-z]+?)s?\s*", gap.lower())
        if not m or m.group(2) not in _UNITS:
            raise ValueError(f"unsupported gap: {gap!r}")
        micros = int(m.group(1)) * _UNITS[m.group(2)]
    if micros <= 0:
        raise ValueError(f"gap must be positive: {gap!r}")
    return micros


def _prepare(df: DataFrame, spec: SessionSpec) -> DataFrame:
    """Keep only page views and clicks (cut after the type filter) and the
    columns the cut needs, under internal names."""
    ts_type = df.schema[spec.ts].dataType
    kinds = df[spec.kind]
    extra = list(dict.fromkeys([*spec.first, *spec.landing]))
    return (df.filter(kinds.isin(spec.pageview, spec.click))
              .select(F.col(spec.user).alias("_u"),
                      F.col(spec.ts).alias("_t"),
                      epoch_micros(spec.ts, ts_type).alias("_us"),
                      *([F.col(spec.order).alias("_rid")] if spec.order else []),
                      (kinds == spec.pageview).alias("_pv"),
                      (kinds == spec.click).alias("_ck"),
                      *[F.col(c) for c in extra])
              .filter(F.col("_us").isNotNull() & F.col("_u").isNotNull()))


def unusable_rows(df: DataFrame, spec: SessionSpec) -> DataFrame:
    """Rows of a kept type that no session can take, with a ``reason``: a null
    visitor or a null time. The cut leaves exactly these out."""
    reason = (F.when(F.col(spec.user).isNull(), F.lit("null_visitor"))
               .when(F.col(spec.ts).isNull(), F.lit("null_time")))
    return df.filter(df[spec.kind].isin(spec.pageview, spec.click)).withColumn("reason", reason).filter("reason IS NOT NULL")


def _first_struct(spec: SessionSpec) -> Column:
    # Struct order is field order: (time, id) is total, the rest rides along.
    return F.struct(F.col("_us"), F.col("_rid"), F.col("_t"),
                    *[F.col(c) for c in spec.first])


def _landing_struct(spec: SessionSpec, with_first: bool = True) -> Column:
    # The page-view anchor also opens its session, so it carries the first-row
    # columns; the gap strategy only needs the landing columns.
    cols = [*spec.first, *spec.landing] if with_first else list(spec.landing)
    return F.struct(F.col("_us"), F.col("_rid"), F.col("_t"),
                    *[F.col(c) for c in dict.fromkeys(cols)])


def _finish(s: DataFrame, spec: SessionSpec, first: str, land: str) -> DataFrame:
    out = [F.col("_u").alias(spec.user),
           F.col(f"{first}._t").alias("session_start"),
           F.col(f"{first}._rid").alias("first_order"),
           *[F.col(f"{first}.{c}").alias(c) for c in spec.first],
           *[F.col(f"{land}.{c}").alias(f"landing_{c}") for c in spec.landing],
           F.col("_npv").cast("int").alias("pageview_count"),
           F.col("_nck").cast("int").alias("click_count")]
    return s.select(*out)


# Below this gap a visitor can have very many cells, so they are joined in two levels.
SMALL_GAP = 10 * _UNITS["minute"]
COARSE = 4096  # cells of a stretch


def join_near(parts: DataFrame, gap: int, taken: list[str], order: str = "_lo", within: tuple[str, ...] = ("_u",)) -> DataFrame:
    """Sessions of a visitor's parts (``_u``, first and last time ``_lo`` and ``_hi``, what is
    ``taken`` by its minimum, counts): parts no more than ``gap`` apart are one session.
    No two parts overlap and ``order`` is theirs in time. The result has the same columns,
    so sessions can be parts again."""
    w = Window.partitionBy(*within).orderBy(order)
    prev_hi = F.lag("_hi").over(w)
    parts = parts.withColumn(
        "_new", F.when(prev_hi.isNull() | ((F.col("_lo") - prev_hi) > gap), 1).otherwise(0))
    parts = parts.withColumn(
        "_seq", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return (parts.groupBy(*within, "_seq")
                 .agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"), *[F.min(k).alias(k) for k in taken],
                      F.sum("_npv").alias("_npv"), F.sum("_nck").alias("_nck"))
                 .drop("_seq"))


def join_in_stretches(cells: DataFrame, gap: int, taken: list[str], coarse: int = COARSE) -> DataFrame:
    """``join_near`` over cells in two levels: first within stretches of ``coarse`` cells, then
    only the first and the last session of each stretch across them; what lies between is
    done. So a window holds ``coarse`` cells, or two sessions for each of a visitor's stretches."""
    stretch = floor_div(F.col("_cell"), coarse)
    near = join_near(cells.withColumn("_stretch", stretch), gap, taken, "_cell", ("_u", "_stretch"))
    own = Window.partitionBy("_u", "_stretch")
    near = near.withColumn("_edge", (F.col("_lo") == F.min("_lo").over(own)) | (F.col("_lo") == F.max("_lo").over(own)))
    inner, edges = near.where("NOT _edge").drop("_edge", "_stretch"), near.where("_edge").drop("_edge", "_stretch")
    return join_near(edges, gap, taken).unionByName(inner)


def gap_parts(df: DataFrame, spec: SessionSpec, gap: str | int = DEFAULT_GAP, coarse: int = COARSE) -> DataFrame:
    """Gap sessions in the form that ``join_near`` takes and ``finish_gap`` turns into rows."""
    g = gap_micros(gap)
    x = _prepare(df, spec).withColumn("_cell", floor_div(F.col("_us"), g))
    if spec.order is None:
        if spec.first or spec.landing:
            raise ValueError("columns of the first row or page view need an order column")
        # fixed-width values only: aggregated by hash, without a sort
        taken = {"_first": F.min("_t")}
    else:
        taken = {"_first": F.min(_first_struct(spec)),
                 "_land": F.min(F.when(F.col("_pv"), _landing_struct(spec, with_first=False)))}
    cells = (x.groupBy("_u", "_cell")
              .agg(F.min("_us").alias("_lo"),
                   F.max("_us").alias("_hi"),
                   *[v.alias(k) for k, v in taken.items()],
                   F.count_if(F.col("_pv")).alias("_npv"),
                   F.count_if(F.col("_ck")).alias("_nck")))
    if g < SMALL_GAP:
        return join_in_stretches(cells, g, list(taken), coarse)
    return join_near(cells, g, list(taken), "_cell")


def finish_gap(s: DataFrame, spec: SessionSpec) -> DataFrame:
    """Session rows of ``gap_parts``."""
    if spec.order is None:
        return s.select(F.col("_u").alias(spec.user), F.col("_first").alias("session_start"),
                        F.col("_npv").cast("int").alias("pageview_count"), F.col("_nck").cast("int").alias("click_count"))
    return _finish(s, spec, "_first", "_land")


def gap_sessions(df: DataFrame, spec: SessionSpec, gap: str | int = DEFAULT_GAP) -> DataFrame:
    """A new session starts when a row is more than ``gap`` after the previous
    row of the same visitor (strictly greater; exactly ``gap`` stays)."""
    return finish_gap(gap_parts(df, spec, gap), spec)


# Page views: width of a visitor's time cells, and rows of one cell that a task may scan.
PAGEVIEW_CELL = "1 hour"
DENSE_ROWS = 200_000
BROADCAST_CELLS = 200_000


def _segments(x: DataFrame, dense_rows: int) -> DataFrame:
    """Rows with ``_part``: -1, or in a cell of more than ``dense_rows`` rows the number of a slice
    of it, so that (visitor, cell, part) is a stretch of the visitor's rows that one task scans.

    The cells' sizes come from an aggregate that is combined before its exchange. Only rows
    of dense cells pass a range exchange, which cuts them into balanced slices."""
    checkpoint_dir(x.sparkSession)
    dense = (x.groupBy("_u", "_cell").agg(F.count("*").alias("_n")).where(F.col("_n") > dense_rows)
              .select(F.col("_u").alias("_du"), F.col("_cell").alias("_dc")).checkpoint(eager=True))
    n = dense.count()  # at most rows / dense_rows
    if not n:
        return x.withColumn("_part", F.lit(-1))
    if n <= BROADCAST_CELLS:
        dense = F.broadcast(dense)
    same = (F.col("_u") == F.col("_du")) & (F.col("_cell") == F.col("_dc"))
    cut = x.join(dense, same, "left_semi").repartitionByRange("_u", "_us", "_rid").withColumn("_part", F.spark_partition_id())
    return x.join(dense, same, "left_anti").withColumn("_part", F.lit(-1)).unionByName(cut)


def pageview_sessions(df: DataFrame, spec: SessionSpec, cell: str | int = PAGEVIEW_CELL, dense_rows: int = DENSE_ROWS) -> DataFrame:
    """Every page view opens a session; clicks before a visitor's first page
    view form one leading session of their own.

    A segmented scan: rows are dealt once, by (visitor, time cell), a cell with too many rows in
    slices; each segment is scanned for itself, and what its head lacks, the latest page view
    before it, is carried over from the summaries of the visitor's earlier segments.

    The segments' partial sessions are written once to the checkpoint folder when the plan is
    built (an eager job): two branches read them, and slices of a range exchange that is
    computed twice need not be the same."""
    x = _prepare(df, spec).withColumn("_cell", floor_div(F.col("_us"), gap_micros(cell)))
    r = _segments(x, dense_rows)
    w = (Window.partitionBy("_u", "_cell", "_part").orderBy("_us", "_rid")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # Latest page view at or before the row inside the segment (the order is
    # total, so the running max of the struct is the latest one).
    r = r.withColumn("_anchor", F.max(F.when(F.col("_pv"), _landing_struct(spec))).over(w))
    part = (r.groupBy("_u", "_cell", "_part", "_anchor")
             .agg(F.min(_first_struct(spec)).alias("_first"),
                  F.count_if(F.col("_pv")).alias("_npv"),
                  F.count_if(F.col("_ck")).alias("_nck")))
    # ``part`` feeds two branches (the sessions and the carry table) that must
    # see the same slices, so it is always materialised: a reliable checkpoint
    # (in the session's checkpoint folder); it is session-level, far smaller
    # than the rows.
    part = part.checkpoint(eager=True)
    # Rows at the head of a segment before its first page view (anchor null)
    # continue the visitor's latest page view in an earlier segment. A visitor has
    # as many segments as cells with rows, and slices of dense ones; the planner
    # decides how to join what is carried.
    order = F.struct("_cell", "_part")
    per_segment = (part.groupBy("_u", "_cell", "_part")
                       .agg(F.max("_anchor").alias("_tail"),
                            F.max(F.col("_anchor").isNull().cast("int")).alias("_head")))
    wb = Window.partitionBy("_u").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    carried = (per_segment.withColumn("_prev", F.max("_tail").over(wb))
                          .filter((F.col("_head") == 1) & F.col("_prev").isNotNull())
                          .select(F.col("_u").alias("_cu"), F.col("_cell").alias("_cc"), F.col("_part").alias("_cp"), "_prev"))
    merged = (part.join(carried,
                        (part["_u"] == carried["_cu"]) & (part["_cell"] == carried["_cc"]) & (part["_part"] == carried["_cp"])
                        & part["_anchor"].isNull(), "left")
                  .withColumn("_anchor", F.coalesce(F.col("_anchor"), F.col("_prev"))))
    s = (merged.groupBy("_u", "_anchor")
               .agg(F.min("_first").alias("_lead"),
                    F.sum("_npv").alias("_npv"),
                    F.sum("_nck").alias("_nck")))
    # A session opened by a page view starts at that page view.
    anchor_first = F.struct(*[F.col(f"_anchor.{f}") for f in ("_us", "_rid", "_t", *spec.first)])
    s = s.withColumn("_first", F.when(F.col("_anchor").isNotNull(), anchor_first)
                                .otherwise(F.col("_lead")))
    return _finish(s, spec, "_first", "_anchor")


STRATEGIES = {"gap": gap_sessions, "pageview": pageview_sessions}


def cut_sessions(df: DataFrame, spec: SessionSpec, strategy: str = "gap",
                 gap: str | int = DEFAULT_GAP) -> DataFrame:
    """Pluggable cutting strategy: ``'gap'`` or ``'pageview'``."""
    key = strategy.lower().replace("_", "").replace("-", "")
    if key in ("gap", "time", "inactivity"):
        return gap_sessions(df, spec, gap)
    if key in ("pageview", "pv", "page"):
        return pageview_sessions(df, spec)
    raise ValueError(f"unknown session strategy {strategy!r}; use 'gap' or 'pageview'")


def with_session_id(sessions: DataFrame, user: str, random: bool = False) -> DataFrame:
    """Session id: SHA-256 of (visitor, start time, first row id) by default,
    or a random UUID when ``random=True`` (as the reference does)."""
    if random:
        sid = F.expr("uuid()")
    else:
        sid = session_hash_id(user, ts_text("session_start"), "first_order")
    return sessions.withColumn("session_id", sid)
