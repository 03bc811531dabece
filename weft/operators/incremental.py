"""Gap sessions cut one period (a day's log) at a time.

A session that could still grow when its period ends is carried to the next in a table of
open sessions, at most one for each visitor, and joined there with the period's first
session if that starts within the gap. So a period costs its own rows and the open
sessions, never the rows before it, and the sessions of all periods are those of one cut
over all rows.

What a store holds is the chain of its periods: for each, the sessions that were closed in
it, the sessions open at its end, and a digest of the latter. A period's tables become
visible together (``weft.sinks.commits``). A period may be given again: it starts from the
period before it, and its result replaces the earlier one. If the open sessions at its end are
the same as before, the periods after it stay; otherwise they no longer follow and are
taken off the chain, to be given again (``Advanced.dropped`` names them).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.functions.columns import epoch_micros
from weft.operators.sessions import DEFAULT_GAP, SessionSpec, finish_gap, gap_micros, gap_parts, join_near
from weft.sinks.commits import Commits


@dataclass(frozen=True)
class Advanced:
    """What one period did: commit number, sessions closed and open, periods that must be given again."""

    number: int
    closed: int
    open: int
    dropped: tuple[str, ...]


class SessionStore:
    """Sessions of a log that is given period by period, under one folder."""

    def __init__(self, spark: SparkSession, base: str, spec: SessionSpec, gap: str | int = DEFAULT_GAP):
        self.spark, self.spec, self.gap = spark, spec, gap_micros(gap)
        self.given = gap
        self.commits = Commits(spark, base)

    def _chain(self) -> list[dict]:
        latest = self.commits.latest()
        return latest.notes["chain"] if latest else []

    def periods(self) -> list[str]:
        return [p["period"] for p in self._chain()]

    def _within(self, rows: DataFrame, start, end):
        kind = rows.schema[self.spec.ts].dataType
        first, stop = (F.lit(str(t)).cast(kind) for t in (start, end))
        return F.col(self.spec.ts) >= first, F.col(self.spec.ts) < stop, epoch_micros(stop, kind)

    def outside(self, rows: DataFrame, start, end) -> DataFrame:
        """Rows of a period's log whose time is not in it: ``advance`` leaves them out."""
        after, before, _ = self._within(rows, start, end)
        return rows.where(~(after & before))

    def advance(self, rows: DataFrame, period: str, start, end) -> Advanced:
        """Cut the rows of one period, with times in [``start``, ``end``); periods sort by their
        names and follow one another in time."""
        after, before, stop = self._within(rows, start, end)
        run, chain = self.commits.begin(), self._chain()
        earlier = [p for p in chain if p["period"] < period]
        parts = gap_parts(rows.where(after & before), self.spec, self.given)
        taken = [c for c in ("_first", "_land") if c in parts.columns]
        if earlier:
            parts = join_near(parts.unionByName(self.spark.read.schema(parts.schema).parquet(earlier[-1]["open"])), self.gap, taken)
        # one write for both: each session is in the folder of its state
        may_grow = stop - F.col("_hi") <= self.gap
        told = parts.withColumn("open", may_grow.cast("int"))
        told.write.partitionBy("open").parquet(run.path("sessions"))
        both = self.spark.read.schema(told.schema).parquet(run.path("sessions"))
        sizes = {r.open: r for r in both.groupBy("open").agg(F.count("*").alias("n"),
                                                             F.sum(F.xxhash64(*parts.columns).cast("decimal(38,0)")).cast("string").alias("digest")).collect()}
        own = {"period": period, "open": f"{run.path('sessions')}/open=1", "closed": f"{run.path('sessions')}/open=0",
               "closed_rows": sizes[0].n if 0 in sizes else 0, "open_rows": sizes[1].n if 1 in sizes else 0,
               "digest": sizes[1].digest if 1 in sizes else ""}
        for state, rows_key in (("open", "open_rows"), ("closed", "closed_rows")):
            if not own[rows_key]:  # an empty state has no folder of its own
                own[state] = run.path(f"no-{state}")
                self.spark.createDataFrame([], parts.schema).write.parquet(own[state])
        before_it = [p for p in chain if p["period"] == period]
        later = [p for p in chain if p["period"] > period]
        follows = bool(before_it) and before_it[0]["digest"] == own["digest"] and before_it[0]["open_rows"] == own["open_rows"]
        dropped = () if follows else tuple(p["period"] for p in later)
        committed = run.commit(chain=[*earlier, own, *(later if follows else [])])
        return Advanced(committed.number, own["closed_rows"], own["open_rows"], dropped)

    def sessions(self, with_open: bool = True) -> DataFrame:
        """Session rows of all committed periods; ``with_open`` adds those that may still grow."""
        chain = self._chain()
        if not chain:
            raise FileNotFoundError("no period is committed")
        folders = [p["closed"] for p in chain] + ([chain[-1]["open"]] if with_open else [])
        tables = [self.spark.read.parquet(f) for f in folders]
        return finish_gap(reduce(DataFrame.unionByName, tables), self.spec)

