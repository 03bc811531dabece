"""Flight-file statistics job: parse, then counts, summaries and cubes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.operators import stats
from weft.sinks.writers import write_csv
from weft.sources.formats import Parsed, parse_airports, parse_flights, read_lines


def load_flights(spark: SparkSession, path: str) -> Parsed:
    return parse_flights(read_lines(spark, path))


def load_airports(spark: SparkSession, path: str) -> Parsed:
    return parse_airports(read_lines(spark, path))


# Airports up to which their table is sent to every task (about 200 bytes each).
BROADCAST_AIRPORTS = 100_000


def with_airports(flights: DataFrame, airports: DataFrame, columns: tuple[str, ...] = ("airport", "city", "state", "lat", "lng")) -> DataFrame:
    """Flights with the ``columns`` of their origin's and destination's airport, as
    ``origin_<column>`` and ``dest_<column>``; null where the code is no airport's. Of several lines with one
    code the greatest counts.

    The airports are counted first: as few as they are in practice they reach the flights
    by broadcast, so flights are not moved for either join; beyond ``BROADCAST_AIRPORTS``
    Spark's planner chooses, and splits hot codes."""
    one = airports.groupBy("iata").agg(F.max(F.struct(*columns)).alias("of"))
    if one.count() <= BROADCAST_AIRPORTS:
        one = F.broadcast(one)
    for end in ("origin", "dest"):
        side = one.select(F.col("iata").alias("_code"), *[F.col(f"of.{c}").alias(f"{end}_{c}") for c in columns])
        flights = flights.join(side, F.col(end) == F.col("_code"), "left").drop("_code")
    return flights


def elapsed_summary(flights: DataFrame) -> DataFrame:
    """min / max / avg / sum of actual elapsed time; -1 sentinels included,
    as the reference includes them (E7)."""
    c = F.col("times.actualElapsedTime")
    return flights.agg(F.min(c).alias("min_elapsed"), F.max(c).alias("max_elapsed"),
                       F.avg(c).alias("avg_elapsed"), F.sum(c).alias("sum_elapsed"))


def route_cube(flights: DataFrame) -> DataFrame:
    """Cube over (origin, dest) with count and two averages, by average
    distance descending (E9, G6)."""
    return stats.cube_lattice(
        flights, ["origin", "dest"],
        {"count": stats.rows_measure(),
         "avg_elapsed": stats.avg_measure("times.actualElapsedTime"),
         "avg_distance": stats.avg_measure("distance")}).orderBy(F.col("avg_distance").desc())


def flight_reports(flights: DataFrame) -> dict[str, DataFrame]:
    """All questions of the flight job over parsed flight rows."""
    return {
        "cancelled_by_month": stats.cancelled_by_month(flights),
        "route_counts": stats.route_counts(flights),
        "route_cube_count": stats.cube_count(flights.select("origin", "dest"), "origin", "dest"),
        "route_cube": route_cube(flights),
        "elapsed_summary": elapsed_summary(flights),
    }


def flight_analysis(spark: SparkSession, flights_path: str | None = None,
                    routes_out: str | None = None, parsed: Parsed | None = None,
                    shuffle_partitions: int | None = None) -> dict[str, DataFrame]:
    """All questions of the flight job as DataFrames; ``routes_out`` also
    writes the route counts as header-less CSV (L5). Pass a ``persist()``-ed
    ``parsed`` to answer every question from one pass over the input.
    ``shuffle_partitions`` sets the session's shuffle partition count (L7);
    by default it is left to the cluster setting and AQE coalescing."""
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if parsed is None:
        if not flights_path:
            raise ValueError("give flights_path or parsed")
        parsed = load_flights(spark, flights_path)
    out = flight_reports(parsed.rows)
    if routes_out:
        write_csv(out["route_counts"], routes_out)
    return out
