"""Label lookups: literal dimensions, left joins with a default, fan-out.

A literal dimension is a map literal (bounded by construction, no join at
all). A table-backed label side is left to Spark: it broadcasts only when the
file statistics or, under AQE, the measured shuffle size is below the
broadcast threshold, and otherwise keeps the shuffle join.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.functions.columns import MISSING_STRING

# The reference's domain -> label dimension.
DOMAIN_LABELS = {
    "www.baidu.com": "level1",
    "www.ali.com": "level2",
    "jd.com": "level3",
    "youku.com": "level4",
}

def literal_dimension(spark: SparkSession, mapping: Mapping[str, str],
                      key: str = "domain", value: str = "domain_label") -> DataFrame:
    """A key -> label dimension from a literal mapping (keys unique)."""
    rows = sorted(mapping.items())
    return spark.createDataFrame(rows, f"{key} string, {value} string")


def map_lookup(c: str | Column, mapping: Mapping[str, str],
               default: str = MISSING_STRING) -> Column:
    """Exact-key lookup in a literal map, ``default`` when absent.

    The map is a literal inside the projection: no join, no shuffle, and its
    size is the literal's size.
    """
    if not mapping:
        return F.lit(default)
    kv = [F.lit(x) for item in sorted(mapping.items()) for x in item]
    m = F.create_map(*kv)
    key = F.col(c) if isinstance(c, str) else c
    return F.coalesce(m[key], F.lit(default))


def attach_label(df: DataFrame, labels: DataFrame, key: str, label: str,
                 label_key: str | None = None, default: str = MISSING_STRING) -> DataFrame:
    """Left outer join of ``df`` to ``labels`` on ``key``; unmatched rows get
    ``default``. Duplicate label keys fan out (one output row per match)."""
    lk = label_key or key
    right = labels.select(F.col(lk).alias("__lk"), F.col(label).alias("__lv"))
    out = df.drop(label) if label in df.columns else df
    joined = out.join(right, out[key] == right["__lk"], "left")
    return (joined.withColumn(label, F.coalesce(F.col("__lv"), F.lit(default)))
                  .drop("__lk", "__lv"))


def attach_unique_label(df: DataFrame, labels: DataFrame, key: str, label: str,
                        label_key: str | None = None, default: str = MISSING_STRING) -> DataFrame:
    """Like ``attach_label`` but with map semantics: one label per key
    (the greatest one when a key repeats), so no fan-out."""
    lk = label_key or key
    uniq = labels.groupBy(F.col(lk).alias(lk)).agg(F.max(label).alias(label))
    return attach_label(df, uniq, key, label, lk, default)


ROWS_PER_SALT = 100_000
# Of the label side's keys, so many of the most frequent are told by a sketch that tracks TRACKED
# keys: a key that holds more than some 4 / TRACKED of the rows is always among those it tracks.
HEAVY_KEYS = 1_000
TRACKED = 100_000


def heavy_keys(df: DataFrame, key: str, rows: int, most: int = HEAVY_KEYS) -> list[tuple]:
    """(key, about how many rows) of the keys with more than ``rows`` rows, ``most`` at most: one
    scan of the key column, with a mergeable summary of the frequent ones and no shuffle of rows."""
    found = df.select(F.col(key).alias("k")).where("k IS NOT NULL").agg(F.expr(f"approx_top_k(k, {most}, {max(TRACKED, most)})")).first()[0]
    return [(r["item"], r["count"]) for r in found or [] if r["count"] > rows]


def salted_left_join(df: DataFrame, labels: DataFrame, key: str, label: str,
                     label_key: str | None = None, default: str = MISSING_STRING,
                     rows_per_salt: int = ROWS_PER_SALT,
                     row_key: tuple[str, ...] | None = None) -> DataFrame:
    """Left join with fan-out whose label side may hold a hot key.

    AQE can split the left side of a left join, not the right, so one label
    key with millions of rows would put its whole fan-out in one task. The keys
    with more than ``rows_per_salt`` label rows are found first (``heavy_keys``) and have
    as many salts as they need, sent to both sides as a table of ``HEAVY_KEYS`` rows at most:
    a label row takes the salt that a hash of its ``row_key`` columns (default: all)
    names, the same in every attempt of a task, and a left row is repeated once per salt of
    its key. A heavy key always has matches, so copies that meet an empty salt
    are dropped. The rows are those of the plain left join, whatever the summary says.
    """
    lk = label_key or key
    heavy = [(k, -(-n // rows_per_salt)) for k, n in heavy_keys(labels, lk, rows_per_salt)]
    if not heavy:
        return attach_label(df, labels, key, label, lk, default)
    kind = labels.schema[lk].dataType.simpleString()
    salts = F.broadcast(df.sparkSession.createDataFrame(heavy, f"__hk {kind}, __salts int"))
    row = F.xxhash64(*(row_key or labels.columns))
    right = (labels.select(F.col(lk).alias("__lk"), F.col(label).alias("__lv"), row.alias("__row"))
                   .join(salts, F.col("__lk") == F.col("__hk"), "left")
                   .select("__lk", "__lv", F.pmod("__row", F.coalesce("__salts", F.lit(1))).cast("int").alias("__rs")))
    out = df.drop(label) if label in df.columns else df
    left = (out.join(salts, out[key] == F.col("__hk"), "left")
               .withColumn("__ls", F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1)))
               .drop("__hk"))
    joined = left.join(right, (left[key] == right["__lk"]) & (left["__ls"] == right["__rs"]), "left")
    joined = joined.filter(F.col("__salts").isNull() | F.col("__lk").isNotNull())
    return (joined.withColumn(label, F.coalesce(F.col("__lv"), F.lit(default)))
                  .drop("__lk", "__lv", "__rs", "__ls", "__salts"))
