"""Grouped, sorted and cubed statistics over record DataFrames.

All of these are hash aggregates with a partial (map-side) step before the
shuffle, so a hot group key costs one partial row per input partition, not
one task holding all its rows. Sorted outputs are global sorts (range
exchange); a top-n becomes ``TakeOrderedAndProject`` (no full sort).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def positive(df: DataFrame, column: str | Column) -> DataFrame:
    """Numeric comparison filter ``column > 0``."""
    return df.filter(_c(column) > 0)


def count_by(df: DataFrame, *keys: str | Column, count_name: str = "count",
             order: str | None = "keys") -> DataFrame:
    """Count per group (E5, E6). ``order='keys'`` sorts by the keys ascending
    (G2); ``order='count'`` sorts by count descending then keys (G3)."""
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name))
    names = [k if isinstance(k, str) else None for k in keys]
    key_cols = [F.col(n.split(".")[-1]) for n in names if n] if all(names) else list(keys)
    if order == "keys":
        return out.orderBy(*key_cols)
    if order == "count":
        return out.orderBy(F.col(count_name).desc(), *key_cols)
    return out


def cancelled_by_month(flights: DataFrame, canceled: str = "canceled",
                       month: str = "date.month") -> DataFrame:
    """Cancelled flights per month, by month."""
    return count_by(positive(flights, canceled), month, order="keys")


def route_counts(flights: DataFrame, origin: str = "origin", dest: str = "dest",
                 top: int | None = None) -> DataFrame:
    """Flights per (origin, dest), by count desc then origin, dest.
    ``top`` keeps the first n rows of that total order (G7)."""
    out = count_by(flights.select(origin, dest), origin, dest, order="count")
    return out.limit(top) if top else out


def summary(df: DataFrame, column: str | Column, prefix: str = "") -> DataFrame:
    """Global min / max / avg / sum of one column (E7): one partial row per
    input partition, one final row."""
    c = _c(column)
    return df.agg(F.min(c).alias(f"{prefix}min"), F.max(c).alias(f"{prefix}max"),
                  F.avg(c).alias(f"{prefix}avg"), F.sum(c).alias(f"{prefix}sum"))


def cube_count(df: DataFrame, *keys: str, count_name: str = "count") -> DataFrame:
    """Count for every subset of the keys (E8); rolled-up keys are null."""
    return df.cube(*keys).agg(F.count(F.lit(1)).alias(count_name))


def cube_agg(df: DataFrame, keys: Sequence[str], aggs: dict[str, Column],
             order_by: str | None = None, descending: bool = True) -> DataFrame:
    """Cube with several named aggregates (E9), optionally sorted by one of
    the aggregate outputs (G6)."""
    out = df.cube(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
    if order_by:
        o = F.col(order_by)
        out = out.orderBy(o.desc() if descending else o.asc())
    return out


@dataclass(frozen=True)
class Measure:
    """An aggregate in mergeable form: states over rows, each with the aggregate that merges
    it, and the result from the merged states (in their order)."""

    states: tuple[tuple[Column, Callable[[Column], Column]], ...]
    result: Callable[..., Column]


def _one(state: Column, merge: Callable[[Column], Column]) -> Measure:
    return Measure(((state, merge),), lambda x: x)


def rows_measure() -> Measure:
    """Number of rows."""
    return _one(F.count(F.lit(1)), F.sum)


def sum_measure(column: str) -> Measure:
    return _one(F.sum(column), F.sum)


def min_measure(column: str) -> Measure:
    return _one(F.min(column), F.min)


def max_measure(column: str) -> Measure:
    return _one(F.max(column), F.max)


def avg_measure(column: str) -> Measure:
    """Sum and count of the values; null where there are none."""
    return Measure(((F.sum(F.col(column).cast("double")), F.sum), (F.count(column), F.sum)), lambda total, n: F.try_divide(total, n))


def cube_lattice(df: DataFrame, keys: Sequence[str], measures: dict[str, Measure]) -> DataFrame:
    """Aggregates for every subset of the keys (E8, E9), rolled-up keys null: the rows are
    aggregated once, by all keys; coarser levels merge the states of that finest level. So
    rows are neither repeated for each subset nor shuffled more than once, partly aggregated."""
    states = {f"__{name}_{k}": state for name, m in measures.items() for k, state in enumerate(m.states)}
    finest = df.groupBy(*keys).agg(*[state.alias(c) for c, (state, _) in states.items()])
    merged = finest.cube(*keys).agg(*[merge(F.col(c)).alias(c) for c, (_, merge) in states.items()])
    return merged.select(*keys, *[m.result(*[F.col(f"__{name}_{k}") for k in range(len(m.states))]).alias(name) for name, m in measures.items()])


def cube_agg_map(df: DataFrame, keys: Sequence[str], aggs: dict[str, str],
                 order_by: str | None = None, descending: bool = True) -> DataFrame:
    """Cube with the map form of ``agg`` (E9): ``{"*": "count",
    "times.actualElapsedTime": "avg", "distance": "avg"}``. Output columns
    get Spark's generated names (``count(1)``, ``avg(distance)``, ...), so a
    sort can name one of them (G6)."""
    out = df.cube(*keys).agg(dict(aggs))
    if order_by:
        o = F.col(f"`{order_by}`")
        out = out.orderBy(o.desc() if descending else o.asc())
    return out
