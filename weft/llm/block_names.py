"""Exact duplicates by deterministic block naming.

A text is cut into blocks of ``BLOCK`` bytes. Blocks are sorted, and each distinct one is
given an integer, its name. Then adjacent names of a text are paired and the pairs named
in the same way, level by level, until each text has one name. Two texts have the same
name at the same level exactly when they are the same bytes: names stand for contents that
were compared, a hash only chooses the cell in which they meet.

Naming (``name_equal``): rows are dealt to cells by a hash of their content, some
``CELL`` rows to a cell, and sorted within it; a name is the cell and the rank there. A
content that more rows share than one task should read is first found by counting hashes
(eight bytes a row, combined before the exchange); its rows are dealt over as many parts
as they need, each part names it, and one representative a part brings these names
together. So the texts cross the network once, and no task reads more than its cells.

Everything here is DataFrame expressions, windows, joins and aggregates. Null texts are
empty; an empty text is one empty block. Rows are told apart by their place in the scan,
so repeated rows, repeated ids and null ids are rows of their own: of equal rows with the
largest id exactly one stays, and a null id stays only where no other row of the group has
an id. An empty table gives no rows. Other columns are left alone, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from weft.llm.common import materialise, table

BLOCK = 4096      # bytes of a block
CELL = 64         # rows of a cell, on average
SPLIT = 1_000     # rows of one content, or of one group of equal texts, that a task may read
HOT = 10_000      # contents beyond that, at most: what is broadcast is as many rows
PART_BITS, RANK_BITS = 14, 18


def _limit(rows: int, split: int) -> int:
    """Rows beyond which a content is hot: less than ``rows / limit <= HOT`` contents can be."""
    return max(split, -(-rows // HOT))


def name_equal(rows: DataFrame, content: str, row_key: list[str], count: int, split: int = SPLIT) -> DataFrame:
    """``rows`` with an integer ``name`` in place of the column ``content``: equal contents,
    equal names. ``count`` is about how many rows there are, ``row_key`` tells them apart.

    Written to the checkpoint folder: the names given in one run of the tasks are the names."""
    limit = _limit(count, split)
    hashed = rows.withColumn("h", F.xxhash64(content))
    hot = (hashed.groupBy("h").count().where(F.col("count") > limit)
                 .select(F.col("h").alias("hot"), F.ceil(F.col("count") / limit).cast("long").alias("parts")))
    dealt = (hashed.join(F.broadcast(hot), F.col("h") == F.col("hot"), "left")
                   .withColumn("cell", F.pmod("h", F.lit(max(1, count // CELL))))
                   .withColumn("part", F.when(F.col("parts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(*row_key), "parts"))))
    cell = Window.partitionBy("cell", "part").orderBy(content)
    ranked = dealt.withColumn("rank", F.dense_rank().over(cell).cast("long")).withColumn("last", F.lag(content).over(cell))
    fits = (F.col("rank") < 1 << RANK_BITS) & (F.col("part") < 1 << PART_BITS)
    name = F.shiftleft(F.shiftleft("cell", PART_BITS) + F.col("part"), RANK_BITS) + F.col("rank")
    shown = F.col("hot").isNotNull() & ~F.col("last").eqNullSafe(F.col(content))
    named = materialise(ranked.select(
        *[c for c in rows.columns if c != content],
        F.when(fits, name).otherwise(F.raise_error(F.lit("a cell has more contents than its names"))).alias("name"),
        F.when(shown, F.col(content)).alias("shown")), "block-names")
    same = (named.where(F.col("shown").isNotNull()).groupBy("shown")
                 .agg(F.min("name").alias("first"), F.collect_list("name").alias("names"))
                 .select("first", F.explode("names").alias("other")).where("first <> other"))
    return (named.join(F.broadcast(same), F.col("name") == F.col("other"), "left")
                 .withColumn("name", F.coalesce("first", "name")).drop("shown", "first", "other"))


def _halves(n: str) -> Column:
    return F.expr(f"({n} + 1) div 2")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK,
             split: int = SPLIT) -> tuple[DataFrame, int]:
    """One row for each row of ``docs``: row (a number), id, text_sha256, level and name; and
    how many there are. Texts are equal exactly when (level, name) is."""
    raw = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    n = F.greatest(F.lit(1).cast("long"), F.expr(f"(size + {block - 1}) div {block}"))
    sizes = docs.select(F.octet_length(raw).cast("long").alias("size")).select(n.alias("n"))
    documents, total, in_pairs, longest = sizes.agg(
        F.count("*"), F.sum("n"), F.sum(F.when(F.col("n") > 1, F.col("n"))), F.max("n")).first()
    cut = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda k: F.substring(F.col("raw"), (k * block + 1).cast("int"), F.lit(block)))
    blocks = (docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), raw.alias("raw"))
                  .withColumn("size", F.octet_length("raw").cast("long")).withColumn("n", n)
                  .select("row", "id", "n", F.sha2("raw", 256).alias("sha"), cut.alias("blocks"))
                  .select("row", "id", "n", "sha", F.posexplode("blocks").alias("pos", "content")))
    first = F.col("pos") == 0  # the first block carries what is told of the whole text
    blocks = blocks.select("row", F.when(first, F.col("id")).alias("id"), F.when(first, F.col("sha")).alias("sha"), "n",
                           F.col("pos").cast("long").alias("pos"), "content")
    named = name_equal(blocks, "content", ["row", "pos"], total or 0, split)
    done, level = [], 0
    while True:
        done.append(named.where("n = 1").select("row", "id", "sha", F.lit(level).alias("level"), "name"))
        if (longest or 0) <= 1:
            break
        level, longest = level + 1, (longest + 1) // 2
        side = [F.max(F.when(F.col("pos") % 2 == k, F.col("name"))) for k in (0, 1)]
        pairs = (named.where("n > 1").groupBy("row", F.expr("pos div 2").alias("pos"))
                      .agg(F.max("id").alias("id"), F.max("sha").alias("sha"), _halves("max(n)").alias("n"),
                           side[0].alias("left"), side[1].alias("right"))
                      .withColumn("content", F.struct("left", "right")).drop("left", "right"))
        named = name_equal(pairs, "content", ["row", "pos"], (in_pairs >> level) + 1, split)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.withColumnRenamed("sha", "text_sha256"), documents


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK,
                     split: int = SPLIT) -> DataFrame:
    """id, keep_id (of the row that stays), group_size, kept and text_sha256 of every row.

    Groups beyond ``split`` rows (``HOT`` of them at most) are broadcast to their rows, the
    others meet theirs in a shuffle join, so no group makes a large task."""
    rows, count = identify(docs, id_col, text_col, block, split)
    groups = rows.groupBy(F.col("level").alias("of"), F.col("name").alias("named")).agg(
        F.count("*").alias("group_size"), F.max(F.struct("id", "row")).alias("keep"))
    same = (F.col("level") == F.col("of")) & (F.col("name") == F.col("named"))
    limit = _limit(count, split)
    large = rows.join(F.broadcast(groups.where(F.col("group_size") > limit)), same, "left")
    rest = large.where(F.col("of").isNull()).select(rows.columns).join(groups.where(F.col("group_size") <= limit), same)
    return large.where(F.col("of").isNotNull()).unionByName(rest).select(
        F.col("id").alias(id_col), F.col("keep.id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"), "text_sha256")


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicate groups of ``documents`` by block names."""
    return exact_duplicates(table(spark, sf_dir, "documents"))


OP12_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
