"""Writers for results: text lines, Parquet, CSV.

Every writer replaces only its own target folder (``mode('overwrite')``), so
sibling outputs under the same base path survive. Writes are distributed:
one file per partition, no driver-side gathering.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the text output format: each record as ``(null,<json>)``.
TEXT_PREFIX = "(null,"
TEXT_SUFFIX = ")"
# Keep full microsecond precision in JSON text (Spark's default is millis).
JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def as_text_lines(df: DataFrame) -> DataFrame:
    """One ``(null,<json record>)`` line per row."""
    rec = F.to_json(F.struct(*[F.col(c) for c in df.columns]), JSON_OPTIONS)
    return df.select(F.concat(F.lit(TEXT_PREFIX), rec, F.lit(TEXT_SUFFIX)).alias("value"))


def write_text(df: DataFrame, path: str) -> None:
    as_text_lines(df).write.mode("overwrite").text(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, header: bool = False) -> None:
    """CSV without header by default."""
    df.write.mode("overwrite").option("header", header).csv(path)


SINKS = {"text": write_text, "parquet": write_parquet, "csv": write_csv}


def select_sink(name: str):
    """Sink by name, case-insensitive (L4); unknown names are an error rather
    than a silent fallback."""
    key = (name or "text").strip().lower()
    if key not in SINKS:
        raise ValueError(f"unknown sink {name!r}; choose one of {sorted(SINKS)}")
    return SINKS[key]


def read_text_records(spark, path: str, schema) -> DataFrame:
    """Read back ``(null,<json>)`` lines into typed rows."""
    lines = spark.read.text(path)
    body = F.regexp_extract(F.col("value"), r"^\(null,(.*)\)$", 1)
    return lines.select(F.from_json(body, schema, JSON_OPTIONS).alias("r")).select("r.*")


def preview(df: DataFrame, n: int = 20, truncate: bool | int = True) -> None:
    """Console preview of the first ``n`` rows (G7). Only ``n`` rows reach
    the driver; after an ``orderBy`` Spark plans it as a top-n."""
    df.show(n, truncate)


def print_schema(df: DataFrame) -> None:
    """Print the schema tree (L8); ``df.schema`` is the programmatic form."""
    df.printSchema()
