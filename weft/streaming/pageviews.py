"""Page-view sessions on a stream: keyed state with timers.

The same sessions as the batch page-view strategy: every page view of a visitor opens one,
clicks belong to the latest page view before them, clicks before the first are a session
of their own. Which page view is the latest is told by time, so a visitor's rows wait in
the state until the watermark has passed them and are then taken in (time, order). A
session is written when the visitor's next page view is taken, or by a timer once the watermark
is ``idle`` beyond its last row; its state goes with it. A click later than that opens a
session of its own, which is the one difference to the batch form: choose ``idle`` above the
longest pause that a session may have.

State of a visitor: the open session and the rows of the watermark's delay. Rows of a visitor
are taken by one task for each micro-batch, as order asks, in the chunks that Spark gives.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from weft.functions.columns import epoch_micros
from weft.operators.sessions import SessionSpec, gap_micros
from weft.sinks.writers import JSON_OPTIONS

_SHAPE = "_us long, _rid long, _first string, _land string, _npv int, _nck int"


class _Visitor:
    """A visitor's waiting rows and open session; a row is (time, order, is page view, first, landing)."""

    def __init__(self, waiting: list[tuple] | None = None, open_: list | None = None):
        self.waiting, self.open = waiting or [], open_

    def take(self, watermark: int, idle: int) -> Iterator[list]:
        """Sessions that end with the rows up to the watermark: [time, order, first, landing, page views, clicks, last time]."""
        ready = sorted((r for r in self.waiting if r[0] <= watermark), key=lambda r: r[:2])
        self.waiting = [r for r in self.waiting if r[0] > watermark]
        for us, order, view, first, landing in ready:
            if self.open is not None and (view or us - self.open[6] > idle):
                yield self.open
                self.open = None
            if self.open is None:
                self.open = [us, order, first, landing if view else None, 0, 0, us]
            self.open[4 if view else 5] += 1
            self.open[6] = us
        if self.open is not None and watermark - self.open[6] > idle:
            yield self.open
            self.open = None

    def wakes(self, idle: int) -> int | None:
        """When there will be something to do, if no row comes."""
        due = [min(r[0] for r in self.waiting)] if self.waiting else []
        return min(due + ([self.open[6] + idle] if self.open is not None else []), default=None)


def _keeper(idle: int):
    def keep(key: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        visitor = _Visitor(*pickle.loads(state.get[0])) if state.exists else _Visitor()
        for frame in [] if state.hasTimedOut else frames:
            visitor.waiting.extend(zip(*(frame[c].tolist() for c in ("_us", "_rid", "_pv", "_first", "_land")), strict=True))
        watermark = state.getCurrentWatermarkMs()
        ended = list(visitor.take(watermark * 1000, idle))
        due = visitor.wakes(idle)
        if due is None:
            state.remove()
        else:
            state.update((pickle.dumps((visitor.waiting, visitor.open)),))
            state.setTimeoutTimestamp(max(due // 1000 + 1, watermark + 1))
        if ended:
            yield pd.DataFrame([(key[0], *s[:6]) for s in ended], columns=["_u", "_us", "_rid", "_first", "_land", "_npv", "_nck"])
    return keep


def pageview_sessions(stream: DataFrame, spec: SessionSpec, watermark: str = "1 hour", idle: str = "1 day") -> DataFrame:
    """Streaming page-view sessions, one row each, in the columns of the batch form. ``spec.order`` is a long.

    Rows without a visitor or a time are left out. ``watermark`` is how late a row may come;
    later ones are dropped by the state operator. Run it in append mode."""
    kinds, ts_type = F.col(spec.kind), stream.schema[spec.ts].dataType
    user = stream.schema[spec.user].dataType
    micros = epoch_micros(spec.ts, ts_type)
    view = kinds == spec.pageview
    # what a session takes from a row travels as text: pandas has no nullable integers of its own
    told = lambda cols: F.to_json(F.struct(*[F.col(c) for c in cols]), JSON_OPTIONS) if cols else F.lit("{}")
    rows = (stream.filter(kinds.isin(spec.pageview, spec.click) & F.col(spec.user).isNotNull() & F.col(spec.ts).isNotNull())
                  .select(F.col(spec.user).alias("_u"), F.timestamp_micros(micros).alias("_et"), micros.alias("_us"), F.col(spec.order).cast("long").alias("_rid"),
                          view.alias("_pv"), told(spec.first).alias("_first"), F.when(view, told(spec.landing)).alias("_land"))
                  .withWatermark("_et", watermark))
    out = rows.groupBy("_u").applyInPandasWithState(
        _keeper(gap_micros(idle)), f"_u {user.simpleString()}, {_SHAPE}", "kept binary", "append", GroupStateTimeout.EventTimeTimeout)
    fields = {f.name: f for f in stream.schema.fields}
    parsed = lambda c, cols: F.from_json(c, T.StructType([fields[n] for n in cols]), JSON_OPTIONS)
    start = F.timestamp_micros("_us")
    if isinstance(ts_type, T.TimestampNTZType):
        start = F.timestamp_add("MICROSECOND", F.col("_us"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    found = out.withColumns({**({"_f": parsed("_first", spec.first)} if spec.first else {}), **({"_l": parsed("_land", spec.landing)} if spec.landing else {})})
    return found.select(F.col("_u").alias(spec.user), start.alias("session_start"), F.col("_rid").alias("first_order"),
                        *[F.col(f"_f.{c}").alias(c) for c in spec.first], *[F.col(f"_l.{c}").alias(f"landing_{c}") for c in spec.landing],
                        F.col("_npv").alias("pageview_count"), F.col("_nck").alias("click_count"))
