"""Line-format readers: each turns a ``value`` text column into typed rows
plus a rejects output (``value``, ``reason``).

Parsing is one projection over the lines (split / trims / lenient casts),
so it stays narrow: no shuffle, and work grows linearly with the input.
Malformed records are kept as rejects instead of aborting the job;
``Parsed.rows_or_fail()`` restores abort-on-error (FAILFAST).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weft import schemas
from weft.functions.columns import MISSING_INT, jvm_trim, jvm_trim_sql, lenient_int_sql

# Fixed values of the line formats.
LOG_COMMENT_PREFIX = "#"
LOG_SEPARATOR = r"\|"
FLIGHT_MIN_FIELDS = 29
ID_PAYLOAD_SEPARATOR = "::"
AIRPORT_HEADER_PATTERN = r'^\s*"iata"\s*,.*'
AIRPORT_LINE_PATTERN = r'^\s*"([^"]+)"\s*,\s*"([^"]+)"\s*,\s*"?([^"]+)"?\s*,\s*"?([^"]+)"?\s*,\s*"([^"]+)"\s*,\s*([-.\d]+)\s*,\s*([-.\d]+)\s*$'


# The whole line, beside the parsed fields of a visit-log row.
LINE = "line"
# Where a line was read: the file's key and path, the first byte of the split, and a
# number that grows with the lines of a split.
PLACES = ("_file", "_path", "_block", "_place")
# Splits up to which their line counts are sent to every task (some hundred bytes each).
BROADCAST_SPLITS = 200_000


@dataclass(frozen=True)
class Parsed:
    """Typed rows and rejected lines from one pass over the same input.

    Both come from one staged projection (each line with its parse result and
    reject reason). ``persist()`` caches that projection, so a job that writes
    rows and rejects reads its input once.
    """

    rows: DataFrame
    rejects: DataFrame
    staged: DataFrame | None = None
    build: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None

    def persist(self, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> "Parsed":
        if self.staged is None or self.build is None:
            return self
        st = self.staged.persist(level)
        rows, rejects = self.build(st)
        return Parsed(rows, rejects, st, self.build)

    def written(self, path: str) -> "Parsed":
        """The same rows and rejects, read back from one Parquet copy of the
        staged projection, so later outputs read the input once."""
        if self.staged is None or self.build is None:
            return self
        self.staged.write.mode("overwrite").parquet(path)
        st = self.staged.sparkSession.read.schema(self.staged.schema).parquet(path)
        rows, rejects = self.build(st)
        return Parsed(rows, rejects, st, self.build)

    def numbered(self, order_col: str) -> "Parsed":
        """Rows with ``order_col`` = (file, line) in place of where they were read: the file's
        key and the line's number among the kept lines of the files of that key.

        A line's number is its place in its split plus the lines of the splits before it, so it
        does not depend on how files are cut into splits, nor on which other files there
        are. The counts are one row for each split; they reach the rows by broadcast when
        they are few (counted first), so the rows themselves are not moved. Call it after
        ``written``, or the input is read once more for the counts."""
        if self.staged is None:
            raise ValueError("lines of no known place; read them with read_lines(places=True)")
        splits = self.staged.groupBy("_file", "_path", "_block").agg(F.min("_place").alias("_first"), F.count("*").alias("_lines"))
        before = Window.partitionBy("_file").orderBy("_path", "_block").rowsBetween(Window.unboundedPreceding, -1)
        splits = splits.select(F.col("_path").alias("_of_path"), F.col("_block").alias("_of_block"),
                               (F.coalesce(F.sum("_lines").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
        if splits.count() <= BROADCAST_SPLITS:
            splits = F.broadcast(splits)
        order = F.struct(F.col("_file").alias("file"), (F.col("_place") + F.col("_shift")).alias("line"))
        rows = self.rows.join(splits, (F.col("_path") == F.col("_of_path")) & (F.col("_block") == F.col("_of_block")))
        return Parsed(rows.select(*[c for c in self.rows.columns if c not in PLACES], order.alias(order_col)), self.rejects)

    def unpersist(self) -> None:
        if self.staged is not None:
            self.staged.unpersist()

    def derive(self, fn: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]) -> "Parsed":
        """A follow-up step over (rows, rejects) that stays tied to the same
        staged projection (and so to its cache after ``persist``)."""
        build = self.build
        if build is None:
            rows, rejects = fn(self.rows, self.rejects)
            return Parsed(rows, rejects)
        def chained(st: DataFrame) -> tuple[DataFrame, DataFrame]:
            return fn(*build(st))
        rows, rejects = fn(self.rows, self.rejects)
        return Parsed(rows, rejects, self.staged, chained)

    def rows_or_fail(self) -> DataFrame:
        """FAILFAST: raise when any line was rejected, else the rows."""
        bad = self.rejects.limit(1).collect()
        if bad:
            raise ValueError(f"malformed record ({bad[0]['reason']}): {bad[0]['value']!r}")
        return self.rows


def read_lines(spark: SparkSession, path: str | list[str], places: bool = False, file_key: Column | None = None) -> DataFrame:
    """Text lines as ``value`` (A1-A5), one task per file split.

    ``places`` adds where each line was read (``PLACES``) for ``Parsed.numbered``.
    ``file_key`` is a number that names the line's file: by default a hash of its path, else
    made from ``_metadata`` or a partition folder. Files of one key are numbered one after
    the other, by path."""
    lines = spark.read.text(path)
    if not places:
        return lines
    path_col = F.col("_metadata.file_path")
    key = F.xxhash64(path_col) if file_key is None else file_key
    return lines.select("value", key.cast("long").alias("_file"), path_col.alias("_path"),
                        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_place"))


def _split_like_jvm(value: Column, sep: str, trailing: str) -> Column:
    """``String.split`` drops trailing empty fields; Spark's split keeps them.
    Trailing separators are cut with a character trim (no regex)."""
    return F.split(F.rtrim(value, F.lit(trailing)), sep)


PARTS = "_parts"


def _stage(lines: DataFrame, parts: Column) -> DataFrame:
    """Adds ``_parts``, computed once for each line: Catalyst neither repeats
    a generator's input in the filters above it nor moves those below it."""
    return lines.select("*", F.explode(F.array(parts)).alias(PARTS))


def _finish(lines: DataFrame, reason: Column, rows: list[Column], skip: Column | None = None) -> Parsed:
    staged = lines if skip is None else lines.filter(~skip)
    staged = staged.select("*", reason.alias("_reason"))

    def build(st: DataFrame) -> tuple[DataFrame, DataFrame]:
        ok = st.filter(F.col("_reason").isNull()).select(*rows)
        bad = st.filter(F.col("_reason").isNotNull()).select(F.col("value"), F.col("_reason").alias("reason"))
        return ok, bad

    ok, bad = build(staged)
    return Parsed(ok, bad, staged, build)


def parse_visit_log(lines: DataFrame, order_col: str | None = "log_order", keep_line: bool = False) -> Parsed:
    """Pipe-delimited visit log (B1): ``#`` lines skipped, fields 0-4 by
    position, extra fields ignored; fewer than five fields is a reject.

    Lines read with their places keep them, for ``Parsed.numbered``. Other lines
    (made in memory) get ``order_col``, a number in the order of their partitions: it is
    taken before any shuffle, but another partitioning gives other numbers.
    ``keep_line`` adds the whole line (``line``) for later rejects.
    """
    v = F.col("value")
    placed = [c for c in PLACES if c in lines.columns]
    order_col = None if placed else order_col
    if order_col:
        lines = lines.withColumn(order_col, F.monotonically_increasing_id())
    f = F.col(PARTS)
    lines = _stage(lines.filter(~v.startswith(LOG_COMMENT_PREFIX)), _split_like_jvm(v, LOG_SEPARATOR, "|"))
    reason = F.when(F.size(f) < 5, F.lit("short_line"))
    rows = [F.get(f, i).alias(n) for i, n in enumerate(schemas.TRACKER_LOG.fieldNames())]
    rows += [F.col(c) for c in ([order_col] if order_col else placed)]
    if keep_line:
        rows.append(F.col("value").alias(LINE))
    return _finish(lines, reason, rows)


def parse_cookie_labels(lines: DataFrame) -> Parsed:
    """``cookie|label`` lines (B2); a line without a label is a reject."""
    lines, f = _stage(lines, _split_like_jvm(F.col("value"), LOG_SEPARATOR, "|")), F.col(PARTS)
    reason = F.when(F.size(f) < 2, F.lit("short_line"))
    return _finish(lines, reason, [F.get(f, 0).alias("cookie"), F.get(f, 1).alias("cookie_label")])


# Flight record layout: 0-based CSV field -> target (fixed by the file format).
FLIGHT_DATE_FIELDS = {"year": 0, "month": 1, "dayOfMonth": 2, "dayOfWeek": 3}
FLIGHT_TIME_FIELDS = {"depTime": 4, "crsDepTime": 5, "arrTime": 6, "crsArrTime": 7,
                      "actualElapsedTime": 11, "crsElapsedTime": 12, "airTime": 13,
                      "arrDelay": 14, "depDelay": 15, "taxiIn": 19, "taxiOut": 20}
FLIGHT_TOP_FIELDS = [("uniqueCarrier", 8, "str"), ("flightNum", 9, "int"), ("tailNum", 10, "str"),
                     ("origin", 16, "str"), ("dest", 17, "str"), ("distance", 18, "int"),
                     ("canceled", 21, "int"), ("cancellationCode", 22, "str"), ("diverted", 23, "int"),
                     ("carrierDelay", 24, "int"), ("weatherDelay", 25, "int"), ("nasDelay", 26, "int"),
                     ("securityDelay", 27, "int"), ("lateAircraftDelay", 28, "int")]


def flight_columns(fields: str, missing: int | None = MISSING_INT) -> list[Column]:
    """Nested flight record from the array column ``fields`` of raw fields
    (A10, B4, C9), ``missing`` where an integer is blank or none. Built as SQL text: one
    expression per output column instead of a few hundred client-side Column calls."""
    def num(i: int) -> str:
        return lenient_int_sql(f"get(`{fields}`, {i})", missing)

    def text(i: int) -> str:
        return jvm_trim_sql(f"get(`{fields}`, {i})")

    def struct(spec: dict[str, int]) -> str:
        return "named_struct(" + ", ".join(f"'{n}', {num(i)}" for n, i in spec.items()) + ")"

    top = [F.expr(num(i) if k == "int" else text(i)).alias(n) for n, i, k in FLIGHT_TOP_FIELDS]
    return [F.expr(struct(FLIGHT_DATE_FIELDS)).alias("date"),
            F.expr(struct(FLIGHT_TIME_FIELDS)).alias("times"), *top]


def parse_flights(lines: DataFrame, missing: int | None = MISSING_INT) -> Parsed:
    """Comma-delimited flight lines (B3): a header line (first field ending in
    ``year``, any case) is skipped; fewer than 29 fields after dropping
    trailing empties is a reject; integers are lenient: ``missing`` where there is none, -1
    as the format has it, or None for nulls, which statistics leave out."""
    v, f = F.col("value"), F.col(PARTS)
    header = F.lower(F.substring(F.get(f, 0), -4, 4)) == "year"
    reason = (F.when(F.trim(v) == "", F.lit("blank_line"))
               .when(F.size(f) < FLIGHT_MIN_FIELDS, F.lit("short_line")))
    return _finish(_stage(lines.select("value"), _split_like_jvm(v, ",", ",")), reason, flight_columns(PARTS, missing),
                   skip=F.coalesce(header, F.lit(False)))


def parse_airports(lines: DataFrame) -> Parsed:
    """Quoted airport lines by pattern (B5): header skipped; fields trimmed;
    lat / lng go through float precision. A line that does not match, or
    whose coordinates are not numbers, is a reject."""
    v = F.col("value")
    lines = _stage(lines.filter(~v.rlike(AIRPORT_HEADER_PATTERN)),
                   F.array(*[F.regexp_extract(v, AIRPORT_LINE_PATTERN, i) for i in range(1, 8)]))
    g = [F.get(F.col(PARTS), i) for i in range(7)]
    lat = jvm_trim(g[5]).try_cast("float").cast("double")
    lng = jvm_trim(g[6]).try_cast("float").cast("double")
    matches = g[0] != ""  # the first field has a character in any line that matches
    reason = (F.when(~matches, F.lit("bad_line"))
               .when(lat.isNull() | lng.isNull(), F.lit("bad_number")))
    names = schemas.AIRPORT.fieldNames()
    rows = [jvm_trim(g[i]).alias(names[i]) for i in range(5)] + [lat.alias("lat"), lng.alias("lng")]
    return _finish(lines, reason, rows)


def parse_id_payload(lines: DataFrame) -> Parsed:
    """``id::payload`` lines (B6); the payload keeps any later ``::``."""
    v, f = F.col("value"), F.col(PARTS)
    lines = _stage(lines, F.split(v, ID_PAYLOAD_SEPARATOR, 2))
    rid = F.get(f, 0).try_cast("long")
    reason = (F.when(F.size(f) < 2, F.lit("short_line"))
               .when(rid.isNull(), F.lit("bad_id")))
    return _finish(lines, reason, [rid.alias("id"), F.get(f, 1).alias("device")])


def read_json(spark: SparkSession, path: str | list[str], schema: T.StructType,
              multiline: bool = False) -> DataFrame:
    """JSON lines (or one multi-line document) with a declared schema."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def read_csv(spark: SparkSession, path: str | list[str], header: bool = False,
             infer_schema: bool = False, schema: T.StructType | str | None = None,
             sep: str = ",") -> DataFrame:
    """CSV with a declared schema, or inferred types when asked.

    Inference is an extra pass over the input; prefer a schema at scale.
    """
    r = spark.read.option("header", header).option("sep", sep)
    if schema is not None:
        return r.schema(schema).csv(path)
    return r.option("inferSchema", infer_schema).csv(path)


# Shapes of the values that inference tells apart; the whole value must match.
_DIGITS = r"^[+-]?[0-9]+\z"
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[dDfF]?\s*\z"
_SPECIAL = ("NaN", "Inf", "-Inf", "Infinity", "+Infinity", "-Infinity")
_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?(Z|[+-][0-9]{2}:[0-9]{2})?\z"


# Kinds of values, as bits of what a column has been seen to hold.
INT, BIGINT, DECIMAL, DOUBLE, DATE, TIMESTAMP, BOOLEAN, TEXT = (1 << k for k in range(8))
_NUMBER_STARTS = [*"0123456789+-. ", "\t", "\n", "\r", "\x0b", "\f"]


def _kind(c: Column) -> Column:
    """The narrowest kind of a value; null for none. The commonest shapes are told without a pattern."""
    whole = c.try_cast("bigint")
    digits = (F.when((F.length(c) <= 20) & whole.between(-(1 << 31), (1 << 31) - 1), INT)
               .when((F.length(c) <= 20) & whole.isNotNull(), BIGINT)
               .when(F.length(c) <= 38, DECIMAL).otherwise(DOUBLE))
    started = (F.when((F.length(c) <= 9) & (F.btrim(c, F.lit("0123456789")) == ""), INT)
                .when(c.rlike(_DIGITS), digits)
                .when(c.rlike(_NUMBER) | c.isin(*_SPECIAL), DOUBLE)
                .when(c.rlike(_DAY) & c.try_cast("date").isNotNull(), DATE)
                .when(c.rlike(_TIME) & c.try_cast("timestamp").isNotNull(), TIMESTAMP)
                .otherwise(TEXT))
    return (F.when(c.isNull(), F.lit(None)).when(F.substring(c, 1, 1).isin(_NUMBER_STARTS), started)
             .when(c.isin(*_SPECIAL), DOUBLE).when(F.lower(c).isin("true", "false"), BOOLEAN).otherwise(TEXT)).cast("int")


def _merged_type(kinds: int, digits: int) -> str:
    """The narrowest type that holds values of all the kinds; ``digits`` of the longest decimal."""
    numbers, times = kinds & (INT | BIGINT | DECIMAL | DOUBLE), kinds & (DATE | TIMESTAMP)
    if not kinds or kinds & TEXT or sum(map(bool, (numbers, times, kinds & BOOLEAN))) > 1:
        return "string"
    if times:
        return "timestamp" if times & TIMESTAMP else "date"
    if not numbers:
        return "boolean"
    if numbers & DOUBLE:
        return "double"
    if numbers & DECIMAL:
        return f"decimal({max(digits, 20 if numbers & BIGINT else 0)},0)"
    return "bigint" if numbers & BIGINT else "int"


def infer_csv(spark: SparkSession, path: str | list[str], staged: str, header: bool = False, sep: str = ",") -> DataFrame:
    """CSV with inferred types from one read of all rows.

    The rows are copied as text to ``staged`` (Parquet), and while they pass each task
    merges the kinds of values that each column holds: two numbers a column, gathered with
    ``observe``. The typed rows are then casts over the copy. A column takes the narrowest
    of int, bigint, decimal, double, date, timestamp and boolean that fits all its
    values, else string, as it also is without any value."""
    raw = spark.read.option("header", header).option("sep", sep).csv(path)
    cols = [F.col(f"`{n}`") for n in raw.columns]
    kinds = raw.select("*", *[_kind(c).alias(f"__kind{k}") for k, c in enumerate(cols)])
    kinds = kinds.select("*", *[F.when(F.col(f"__kind{k}") == DECIMAL, F.length(F.ltrim(F.regexp_replace(c, "^[+-]", ""), F.lit("0")))).alias(f"__digits{k}")
                                for k, c in enumerate(cols)])
    seen = Observation("types")
    kinds = kinds.observe(seen, *[F.bit_or(f"__kind{k}").alias(f"kinds{k}") for k in range(len(cols))],
                          *[F.max(f"__digits{k}").alias(f"digits{k}") for k in range(len(cols))])
    kinds.select(*cols).write.mode("overwrite").parquet(staged)
    merged = seen.get
    return spark.read.schema(raw.schema).parquet(staged).select(
        *[c.cast(_merged_type(merged[f"kinds{k}"] or 0, merged[f"digits{k}"] or 0)).alias(n) for k, (c, n) in enumerate(zip(cols, raw.columns, strict=True))])
