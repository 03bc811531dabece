"""Merkle manifest of a dataset: a leaf for each row, a tree of fanout three for each
group, a tree of the groups' roots above them, and a proof of membership for every row.

A leaf is the SHA-256 of a row's fields, each ``-`` if null, else its byte count, a colon
and its bytes. Leaves of a group stand in ascending id order (null ids first, equal ids by
their leaf); while more than one node remains, each run of ``FANOUT`` consecutive nodes
becomes the digest of its members' hex text. The groups' roots stand in bytewise order of
the group (null first) and are reduced alike.

Slot pivot: a parent's children are spread into one column for each slot by conditional
aggregates; the slots' columns one after the other hash to the parent, and without the own
column they are a child's siblings. ``ROUND`` levels are taken at a time: nodes meet by
(group, block of ``FANOUT ** ROUND`` places), so a group of any size is spread over as many
tasks as it has blocks, and one exchange and one sort serve all levels of a round. Only
block digests are written between the rounds; the proofs are made on the way down and are
never shuffled.

Repeated rows are leaves of their own. A group of one row has its leaf as its root. An
empty table has no rows and no root. Other columns are left alone, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weft.llm.common import materialise, table
from weft.operators.order import with_positions

FANOUT = 3
ROUND = 6  # levels between two exchanges: blocks of 729 nodes
PROOF = "array<struct<before:string,after:string>>"


def field_bytes(value: Column) -> Column:
    """``-`` for null, else byte count, ``:`` and the bytes of the value's text."""
    raw = value.cast("string").cast("binary")
    return F.coalesce(F.concat(F.octet_length(raw).cast("string").cast("binary"), F.lit(b":"), raw), F.lit(b"-"))


def leaf_digest(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field_bytes, fields)), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to; a verifier compares it with the root."""
    return F.aggregate(proof, leaf, lambda node, level: F.sha2(F.concat(level["before"], node, level["after"]).cast("binary"), 256))


def proof_digest(proof: Column) -> Column:
    """SHA-256 of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda level: F.concat(level["before"], level["after"])), "").cast("binary"), 256)


def _rounds(nodes: DataFrame, levels: int) -> DataFrame:
    """Nodes (key, n, i, digest, ...) dealt by block, with their ancestors' places q1..q``levels``."""
    dealt = nodes.withColumn("block", F.expr(f"i div {FANOUT ** levels}")).repartition("key", "block")
    return dealt.withColumns({f"q{k}": F.expr(f"i div {FANOUT ** k}") for k in range(1, levels + 1)})


def _left(level: int) -> Column:
    """Nodes of a group that remain at a level: places divided by the fanout, rounded up."""
    size = FANOUT ** level
    return F.expr(f"(n + {size - 1}) div {size}")


def _spread(level: int) -> list[Column]:
    """Of the children at a level, one conditional aggregate for each slot."""
    place = "i" if level == 0 else f"q{level}"
    return [F.max(F.when(F.col(place) % FANOUT == slot, F.col("digest"))) for slot in range(FANOUT)]


def _parent(level: int, slots: list[Column], lone: Column) -> Column:
    return F.when(_left(level) > 1, F.sha2(F.concat_ws("", *slots).cast("binary"), 256)).otherwise(lone)


def _chain(levels: int, level: int) -> list[str]:
    """The parents at a level with all their ancestors: each is a prefix of the level below,
    so the rows sorted for the lowest level are sorted for all."""
    return ["key", "block", *[f"q{k}" for k in range(levels, level, -1)]]


def climb(nodes: DataFrame, levels: int = ROUND) -> DataFrame:
    """The nodes (key, n, i, digest) that are left ``levels`` levels higher."""
    rows = _rounds(nodes.select("key", "n", "i", "digest"), levels)
    slots = [f"c{k}" for k in range(FANOUT)]
    for level in range(levels):
        rows = (rows.groupBy(*_chain(levels, level), "n").agg(*[c.alias(s) for c, s in zip(_spread(level), slots, strict=True)])
                    .withColumn("digest", _parent(level, [F.col(s) for s in slots], F.col("c0"))).drop(*slots))
    return rows.select("key", F.expr(f"(n + {FANOUT ** levels - 1}) div {FANOUT ** levels}").alias("n"),
                       F.col("block").alias("i"), "digest")


def descend(nodes: DataFrame, levels: int = ROUND) -> DataFrame:
    """The nodes with ``block`` and their siblings over ``levels`` levels as ``proof``."""
    rows = _rounds(nodes, levels).withColumn("own", F.col("digest"))
    slots = [f"c{k}" for k in range(FANOUT)]
    for level in range(levels):
        family = Window.partitionBy(*_chain(levels, level))
        place = F.col("i" if level == 0 else f"q{level}") % FANOUT
        rows = rows.withColumns({s: c.over(family) for c, s in zip(_spread(level), slots, strict=True)})
        none = F.lit(None).cast("string")
        before = F.concat_ws("", *[F.when(place > k, F.col(s)).otherwise(none) for k, s in enumerate(slots)])
        after = F.concat_ws("", *[F.when(place < k, F.col(s)).otherwise(none) for k, s in enumerate(slots)])
        rows = (rows.withColumn(f"p{level}", F.when(_left(level) > 1, F.struct(before.alias("before"), after.alias("after"))))
                    .withColumn("digest", _parent(level, [F.col(s) for s in slots], F.col("digest"))).drop(*slots))
    proof = F.array_compact(F.array(*[F.col(f"p{k}") for k in range(levels)])).cast(PROOF)
    return (rows.withColumn("proof", proof).withColumn("digest", F.col("own"))
                .drop("own", *[f"p{k}" for k in range(levels)], *[f"q{k}" for k in range(1, levels + 1)]))


def _forest(nodes: DataFrame, name: str) -> list[DataFrame]:
    """The written nodes of every round, from the given ones to one node for each key."""
    largest = nodes.agg(F.max("n")).first()[0] or 0
    floors = [nodes]
    for k in range(max(1, math.ceil(_levels(largest) / ROUND))):
        floors.append(materialise(climb(floors[-1]), f"{name}-{k}"))
    return floors


def _levels(n: int) -> int:
    levels = 0
    while FANOUT ** levels < n:
        levels += 1
    return levels


def _proofs(floors: list[DataFrame], above: DataFrame) -> DataFrame:
    """The lowest nodes with their proofs; ``above`` has key, i, upper (proof) and what else goes down."""
    passed = [c for c in above.columns if c not in ("key", "i", "upper")]
    for k, nodes in enumerate(reversed(floors[:-1])):
        last = k == len(floors) - 2
        over = above.select(F.col("key").alias("__key"), F.col("i").alias("__block"), "upper", *passed)
        joined = descend(nodes).join(over, (F.col("key") == F.col("__key")) & (F.col("block") == F.col("__block")))
        below = joined.withColumn("upper", F.concat("proof", "upper")).drop("__key", "__block", "block", "proof")
        above = below if last else materialise(below.select("key", "i", "upper", *passed), "merkle-down")
    return above


def dataset_manifest(docs: DataFrame, id_col: str, group_col: str, fields: list[str], carry: dict[str, Column] | None = None) -> DataFrame:
    """id, leaf, subroot, root and proof (siblings before and after the node, level by level)
    of every row; ``carry`` names further columns made from the row."""
    carry = carry or {}
    # "" for null, "=" and the value otherwise: equal and in the order of the values
    key = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    leaves = docs.select(key.alias("key"), F.col(id_col).alias("id"), leaf_digest([F.col(c) for c in fields]).alias("digest"),
                         *[c.alias(f"carry_{k}") for k, c in carry.items()])
    nodes = with_positions(leaves, ["id", "digest"], ["key"], position="i", total="n")
    floors = _forest(materialise(nodes, "merkle-leaves"), "merkle-up")
    subroots = floors[-1].select("key", F.col("digest").alias("subroot"))
    groups = with_positions(subroots.select(F.lit("").alias("all"), "key", F.col("subroot").alias("digest")), ["key"], ["all"],
                            position="i", total="n")
    groups = materialise(groups.select(F.col("all").alias("key"), "n", "i", "digest", F.col("key").alias("group")), "merkle-groups")
    top = _forest(groups, "merkle-top")
    crown = top[-1].select("key", "i", F.array().cast(PROOF).alias("upper"), F.col("digest").alias("root"))
    groups = _proofs(top, crown).select(F.col("group").alias("key"), F.lit(0).cast("long").alias("i"), "upper",
                                        F.col("digest").alias("subroot"), "root")
    found = _proofs(floors, materialise(groups, "merkle-groups"))
    return found.select(F.col("id").alias(id_col), F.col("digest").alias("leaf"), "subroot", "root",
                        F.col("upper").alias("proof"), *[F.col(f"carry_{k}").alias(k) for k in carry])


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest and proofs of ``documents``; half of the texts lose their line feeds and are checked against it."""
    docs = table(spark, sf_dir, "documents")
    altered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = leaf_digest([F.replace(F.col(c), F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in FIELDS])
    found = dataset_manifest(docs, "doc_id", "source", FIELDS, {"altered": F.when(altered, tampered)})
    folded = fold(F.coalesce("altered", "leaf"), F.col("proof"))
    return (found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), folded.alias("folded_root"))
                 .withColumn("verified", F.col("folded_root") == F.col("root")))


def _field_sql(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE octet_length(encode(CAST({value} AS VARCHAR))) || ':' || CAST({value} AS VARCHAR) END"


def _leaf_sql(fields: list[str]) -> str:
    return f"sha256({' || '.join(map(_field_sql, fields))})"


_LESS = [f"replace({c}, chr(10), '')" if c == "text" else c for c in FIELDS]
# CRC-32 bit by bit: its polynomial and its start value are fixed.
_CRC_SQL = """xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END)))"""
OP11_SQL = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, coalesce('=' || source, '') AS key, {_leaf_sql(FIELDS)} AS leaf,
         CASE WHEN {_CRC_SQL} % 2 = 0 THEN {_leaf_sql(_LESS)} END AS altered
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY key) AS n FROM hashed),
up(lv, key, i, n, digest) AS (
  SELECT 0, key, i, n, leaf FROM leaves
  UNION ALL
  SELECT lv + 1, key, i // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY i)) FROM up WHERE n > 1 GROUP BY lv, key, i // 3, n),
subroots AS (SELECT key, digest AS subroot, row_number() OVER (ORDER BY key) - 1 AS i, count(*) OVER () AS n FROM up WHERE n = 1),
crown(lv, i, n, digest) AS (
  SELECT 0, i, n, subroot FROM subroots
  UNION ALL
  SELECT lv + 1, i // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY i)) FROM crown WHERE n > 1 GROUP BY lv, i // 3, n),
families AS (
  SELECT 0 AS part, key, lv, i // 3 AS p, list(digest ORDER BY i) AS kids FROM up WHERE n > 1 GROUP BY key, lv, i // 3
  UNION ALL
  SELECT 1, '', lv, i // 3, list(digest ORDER BY i) FROM crown WHERE n > 1 GROUP BY lv, i // 3),
path(part, lv, key, own, i, n, node, siblings) AS (
  SELECT 0, 0, key, i, i, n, coalesce(altered, leaf), '' FROM leaves
  UNION ALL
  SELECT CASE WHEN c.n > 1 THEN c.part ELSE 1 END, CASE WHEN c.n > 1 THEN c.lv + 1 ELSE 0 END, c.key, c.own,
         CASE WHEN c.n > 1 THEN c.i // 3 ELSE s.i END, CASE WHEN c.n > 1 THEN (c.n + 2) // 3 ELSE s.n END,
         CASE WHEN c.n > 1 THEN sha256(array_to_string(f.kids[:c.i % 3] || [c.node] || f.kids[c.i % 3 + 2:], '')) ELSE c.node END,
         CASE WHEN c.n > 1 THEN c.siblings || array_to_string(f.kids[:c.i % 3] || f.kids[c.i % 3 + 2:], '') ELSE c.siblings END
  FROM path c JOIN subroots s ON c.key = s.key
  LEFT JOIN families f ON f.part = c.part AND f.lv = c.lv AND f.p = c.i // 3 AND f.key = CASE c.part WHEN 0 THEN c.key ELSE '' END
  WHERE c.n > 1 OR c.part = 0)
SELECT l.doc_id, l.leaf, s.subroot, (SELECT digest FROM crown WHERE n = 1) AS root, sha256(p.siblings) AS proof_sha256,
       p.node AS folded_root, p.node = (SELECT digest FROM crown WHERE n = 1) AS verified
FROM leaves l JOIN path p ON p.key = l.key AND p.own = l.i AND p.part = 1 AND p.n = 1
JOIN subroots s ON s.key = l.key
"""
