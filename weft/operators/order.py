"""Order as data: the place of every row in a sorted table, without sorting it in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.session import scratch_path

_ROW_BITS = 33  # of monotonically_increasing_id: partition above, row of the partition below


def with_positions(df: DataFrame, order: Sequence[str | Column], group: Sequence[str] = (),
                   position: str = "position", total: str | None = None) -> DataFrame:
    """Add the 0-based place of each row in ``order`` within its ``group`` (default: the
    whole table) and, when ``total`` names a column, the number of rows of the group.

    A range exchange on (group, order) cuts the table, and any large group, into balanced
    slices that follow one another; a row's place is its place in the slice plus the sizes
    of the group's slices before it. The sizes are one row for each slice and group that
    meet, at most slices + groups in all. The slices are written once to the checkpoint
    folder, as a range exchange computed twice need not cut alike.

    Rows that are equal in (group, order) take their places in any order. Nulls sort
    first; a null group value is a group like any other."""
    spark = df.sparkSession
    keys = [*group, *order]
    place = F.monotonically_increasing_id()
    cut = (df.repartitionByRange(*keys).sortWithinPartitions(*keys)
             .withColumn("__slice", F.shiftright(place, _ROW_BITS))
             .withColumn("__row", place.bitwiseAND(F.lit((1 << _ROW_BITS) - 1))))
    path = scratch_path(spark, "positions")
    cut.write.parquet(path)
    rows = spark.read.schema(cut.schema).parquet(path)
    slices = rows.groupBy(*group, "__slice").agg(F.min("__row").alias("__first"), F.count("*").alias("__n"))
    before = Window.partitionBy(*group).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group).orderBy("__slice").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    slices = slices.select(*[F.col(g).alias(f"__g{k}") for k, g in enumerate(group)], F.col("__slice").alias("__s"),
                           (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift"),
                           F.sum("__n").over(whole).alias("__total"))
    same = [F.col("__slice") == F.col("__s"), *[F.col(g).eqNullSafe(F.col(f"__g{k}")) for k, g in enumerate(group)]]
    joined = rows.join(slices, reduce(lambda a, b: a & b, same))
    return joined.select(*df.columns, (F.col("__row") + F.col("__shift")).alias(position),
                         *([F.col("__total").alias(total)] if total else []))
