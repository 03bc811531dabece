"""JSON in columns: extract, parse, filter, serialise, explode.

All built-in expressions: they run per row inside the scan's codegen stage,
so none of them shuffles.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extract_fields(df: DataFrame, json_col: str, paths: Mapping[str, str],
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """``get_json_object`` for several paths (I12): alias -> ``$.path``."""
    return df.select(*keep, *[F.get_json_object(_c(json_col), p).alias(a) for a, p in paths.items()])


def parse_column(df: DataFrame, json_col: str, schema: T.DataType | str,
                 alias: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``from_json`` into a typed struct / map column."""
    return df.select(*keep, F.from_json(_c(json_col), schema).alias(alias))


def expand(df: DataFrame, struct_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Star-expand a struct column into top-level columns."""
    return df.select(*keep, f"{struct_col}.*")


def serialise(df: DataFrame, columns: tuple[str, ...] | None = None,
              alias: str = "json") -> DataFrame:
    """Pack columns (all by default) into a struct and write it as JSON text
    (C11, I14, I20). Null fields are omitted, as ``to_json`` does."""
    cols = [F.col(c) for c in columns] if columns else [F.col(c) for c in df.columns]
    return df.select(F.to_json(F.struct(*cols)).alias(alias))


def explode_map(df: DataFrame, map_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per map entry as ``key`` / ``value`` (I17); null and empty
    maps produce no row."""
    return df.select(*keep, F.explode(_c(map_col)))


def nested(col: str, *path: str) -> Column:
    """Chained field access into structs (I18): ``nested('value','geo','lat')``."""
    c = F.col(col)
    for p in path:
        c = c.getField(p)
    return c
