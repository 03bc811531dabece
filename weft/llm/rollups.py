"""Token counts as rollups that signed batches keep up to date.

A change says that a document came (+), went (-) or was counted anew: (op, source, lang,
tokenizer, n_tokens, old_tokens) with op ``insert``, ``delete`` or ``revise``. Each becomes signed amounts: documents +1, -1
or 0 and tokens +n, -n or n - old. A batch is aggregated to one row for each (source, lang,
tokenizer) before it is stored, so storage and reads follow the number of groups and
batches, not of documents; a source with a third of all rows is summed where it is read.

The log: a folder ``batch=<id>`` for each batch. A batch is written aside and put in place by
a rename that does not replace, so of two senders of one batch one adds it and the other
is told that it was there; one that breaks off leaves nothing that counts. Totals are the sums over
committed batches. ``compact`` folds committed batches into one folder and remembers their ids in a table, so that
replays of folded batches stay without effect; ``expire`` removes what is folded.

Nulls in source or language are groups of their own; null counts are 0; a null op is an error, like any unknown one.
Groups whose documents and tokens are both zero are left out of the totals. Repeated changes within a
batch each count; an empty batch commits and changes nothing."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm.common import materialise, open_store, table
from weft.session import scratch_path
from weft.sinks.commits import rename_new

KEYS = ["source", "lang", "tokenizer"]
DELTA_SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"

# Token patterns of the tokenizer versions that the query counts with.
VERSIONS = {
    "words-1": r"[^\x20\x09-\x0D]+",
    "marks-2": r"[0-9A-Za-z]+|[^0-9A-Za-z\x20\x09-\x0D]",
}


def deltas(changes: DataFrame) -> DataFrame:
    """Signed sums of a batch of changes."""
    count, old = F.coalesce("n_tokens", F.lit(0)).cast("long"), F.coalesce("old_tokens", F.lit(0)).cast("long")
    op = F.col("op")
    wrong = F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce(op, F.lit("null"))))
    docs = F.when(op == "insert", 1).when(op == "delete", -1).when(op == "revise", 0).otherwise(wrong.cast("int"))
    tokens = F.when(op == "insert", count).when(op == "delete", -count).when(op == "revise", count - old).otherwise(wrong.cast("long"))
    return (changes.select(*(F.col(k).cast("string").alias(k) for k in KEYS), docs.cast("long").alias("d"), tokens.alias("t"))
            .groupBy(*KEYS).agg(F.sum("d").alias("n_docs"), F.sum("t").alias("n_tokens")))


class Rollup:
    """A log of batches in a folder of the shared storage."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _listed(self) -> dict[str, str]:
        """Committed folders by name."""
        from pyarrow import fs

        store, place = open_store(self.folder)
        found = store.get_file_info(fs.FileSelector(place, recursive=True, allow_not_found=True))
        done = {os_path[len(place):].strip("/").rsplit("/", 1)[0] for os_path in (f.path for f in found) if os_path.endswith("/_SUCCESS")}
        return {name: f"{self.folder}/{name}" for name in done if "/" not in name}

    def _level(self, listed: dict[str, str]) -> int:
        """The newest compaction (0: none)."""
        return max((int(n.split("=")[1]) for n in listed if n.startswith("folded=")), default=0)

    def _folded(self, listed: dict[str, str], batches: list[str]) -> set[str]:
        """Which of some batches the newest compaction holds; only these ids come to the driver."""
        level = self._level(listed)
        if not level or not batches:
            return set()
        ids = self.spark.read.schema("batch string").parquet(listed[f"ids={level}"])
        return {r[0] for r in ids.where(F.col("batch").isin(batches)).distinct().collect()}

    @staticmethod
    def _batches(listed: dict[str, str]) -> list[str]:
        return sorted(n.split("=", 1)[1] for n in listed if n.startswith("batch="))

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Add a batch; False if it was there already."""
        if not re.fullmatch(r"[A-Za-z0-9._-]+", batch_id):
            raise ValueError(f"a batch id has letters, digits and ._- only: {batch_id!r}")
        listed = self._listed()
        if f"batch={batch_id}" in listed or self._folded(listed, [batch_id]):
            return False
        aside = f"{self.folder}/_aside-{uuid.uuid4().hex}"
        deltas(changes).write.parquet(aside)
        target = f"{self.folder}/batch={batch_id}"
        added = rename_new(self.spark, aside, target)
        if not added and f"batch={batch_id}" not in self._listed():  # a folder without its mark counts for nothing
            self._remove(target)
            added = rename_new(self.spark, aside, target)
        if not added:
            self._remove(aside)
        return added

    def _remove(self, path: str) -> None:
        store, place = open_store(path)
        store.delete_dir(place)

    def compact(self) -> None:
        """Fold all committed batches into one folder. The ids are written first and the folded
        sums last: before that is committed, readers and writers go by the single batches."""
        listed = self._listed()
        level, batches = self._level(listed), self._batches(listed)
        fresh = sorted(set(batches) - self._folded(listed, batches))
        named = self.spark.createDataFrame([(x,) for x in fresh], "batch string")
        if level:
            named = named.unionByName(self.spark.read.schema("batch string").parquet(listed[f"ids={level}"]))
        named.write.mode("overwrite").parquet(f"{self.folder}/ids={level + 1}")
        self._sums(listed).write.mode("overwrite").parquet(f"{self.folder}/folded={level + 1}")

    def expire(self) -> int:
        """Remove the batches that the newest compaction holds and the compactions before it; call
        it when no reader or writer is at work. Returns how many folders went."""
        listed = self._listed()
        level, batches = self._level(listed), self._batches(listed)
        gone = [f"batch={b}" for b in sorted(self._folded(listed, batches))]
        gone += [n for n in listed if n.startswith(("ids=", "folded=")) and int(n.split("=")[1]) < level]
        for name in gone:
            self._remove(listed[name])
        return len(gone)

    def _sums(self, listed: dict[str, str]) -> DataFrame:
        level, batches = self._level(listed), self._batches(listed)
        paths = [listed[f"batch={b}"] for b in sorted(set(batches) - self._folded(listed, batches))]
        paths += [listed[f"folded={level}"]] if level else []
        read = self.spark.read.schema(DELTA_SCHEMA)
        rows = read.parquet(*sorted(paths)) if paths else self.spark.createDataFrame([], DELTA_SCHEMA)
        return rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens over all committed batches."""
        return self._sums(self._listed()).where("n_docs <> 0 OR n_tokens <> 0")


def token_count(text: Column, version: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(VERSIONS[version])), F.lit(0)).cast("long")


def counted(docs: DataFrame) -> DataFrame:
    """doc_id, source, lang, tokenizer, n_tokens: a row for each document and tokenizer version."""
    counts = F.create_map(*(x for v in VERSIONS for x in (F.lit(v), token_count(F.col("text"), v))))
    return docs.select("doc_id", "source", "lang", F.md5(F.col("text").cast("binary")).alias("same"), F.explode(counts).alias("tokenizer", "n_tokens"))


def op10_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals after four batches: all documents come, counted by two tokenizer
    versions (a batch each); of documents with equal texts all but that with the smallest
    id go; documents labelled toxic are redacted, that is, revised to no tokens. The second
    batch is sent twice."""
    rows = materialise(counted(table(spark, sf_dir, "documents")), "token-counts")
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id").distinct().withColumn("toxic", F.lit(True))
    rollup = Rollup(spark, scratch_path(spark, "token-rollups"))
    for version in (*VERSIONS, list(VERSIONS)[-1]):
        rollup.commit(f"load-{version}", rows.where(F.col("tokenizer") == version).select(
            F.lit("insert").alias("op"), *KEYS, "n_tokens", F.lit(0).alias("old_tokens")))
    least = rows.where("same is not null").groupBy("same").agg(F.min("doc_id").alias("first"))
    copies = rows.join(least, "same").where("not (doc_id <=> first)")  # a null id beside others is a copy too
    rollup.commit("copies", copies.select(F.lit("delete").alias("op"), *KEYS, "n_tokens", F.lit(0).alias("old_tokens")))
    kept = rows.join(least, "same", "left").where("first is null or doc_id <=> first")
    redacted = kept.join(toxic, "doc_id", "left").where("toxic")
    rollup.commit("redaction", redacted.select(F.lit("revise").alias("op"), *KEYS, F.lit(0).alias("n_tokens"), F.col("n_tokens").alias("old_tokens")))
    rollup.compact()
    return rollup.totals()


OP10_SQL = """
WITH d AS (
  SELECT doc_id, source, lang, text,
    CASE WHEN text IS NULL THEN doc_id ELSE min(doc_id) OVER (PARTITION BY text) END AS first
  FROM documents
), c AS (
  SELECT *, 'words-1' AS tokenizer, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS n FROM d
  UNION ALL
  SELECT *, 'marks-2' AS tokenizer, CAST(coalesce(len(regexp_extract_all(text, '[0-9A-Za-z]+|[^0-9A-Za-z\\x20\\x09-\\x0D]')), 0) AS BIGINT) AS n FROM d
)
SELECT source, lang, tokenizer, CAST(count(*) AS BIGINT) AS n_docs,
  CAST(sum(CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) THEN 0 ELSE n END) AS BIGINT) AS n_tokens
FROM c WHERE doc_id IS NOT DISTINCT FROM first
GROUP BY source, lang, tokenizer
"""
