"""SimHash near-duplicates found by Golay-code fuzzy hashing.

Fingerprint: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, shingles of four words
(repeats count; a shorter text is one shingle), XXH64 with seed 42 of each; a bit is 1 if
it is set in over half of the hashes. No words: fingerprint 0. Two fingerprints link when
at most ``MAX_BITS`` = 4 bits differ.

Search: the 64 bits are cut into five segments. Four differing bits leave at least one
segment equal, and of the two pairs that the other four segments form one has at most two
differing bits. 23 bits of such a pair are decoded in the perfect (23, 12) Golay code to
the codewords within distance four: one, or six when the nearest is at distance three.
Two words at distance two or less have a word within one bit of both, whose nearest
codeword (distance three at most) is in both sets. So linked fingerprints share a key
(segment, its bits, pair, codeword index); a fingerprint has about 53 keys.

Fingerprints with a common key are compared by their bits. Equal fingerprints are one
node, so copies are not compared at all. Inside a key's rows the search walks from row to
row and gives a spanning forest of the links, not all pairs; a key with more than
``CHUNK`` rows is cut into chunks and each pair of chunks is its own group. Components
follow from the links.

Null texts have no words. Repeated rows are rows of their own with the same class. A null
id takes part in linking, but the class is named by the smallest id that is not null.
An empty table gives no rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weft.llm.common import by_place, canonical_words, materialise, table
from weft.llm.components import components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
CHUNK = 1 << 16
FEW = 8  # groups up to this size are compared pair by pair, all at once

# Generator polynomial of the (23, 12) Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011
# First bit and width of the five segments.
SEGMENTS = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]


def fingerprint(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a text."""
    words = canonical_words(text)
    if not words:
        return 0
    whole = b" ".join(words)
    if len(words) <= shingle_words:
        return xxhash.xxh64_intdigest(whole, SEED)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    stops = np.cumsum(sizes + 1) - 1
    digest = xxhash.xxh64_intdigest
    starts, stops_ = (stops - sizes).tolist(), stops[shingle_words - 1:].tolist()
    hashes = np.array([digest(whole[a:b], SEED) for a, b in zip(starts, stops_, strict=False)], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        ones += np.unpackbits(hashes[at:at + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long), text_hash."""
    def run(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            prints = np.array([fingerprint(x.as_py(), shingle_words) for x in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "fp": prints.view(np.int64),
                                                   "text_hash": batch.column("text_hash")})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"),
                       F.xxhash64(F.col(text_col)).alias("text_hash"))
    return rows.mapInArrow(run, "doc_id long, fp long, text_hash long")


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator."""
    rest = words.astype(np.int64)
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - 11)), rest)
    return rest


@lru_cache(maxsize=1)
def _errors() -> np.ndarray:
    """For each syndrome the error patterns of weight four or less, padded with -1: one
    pattern, or the one of weight three and the five of weight four."""
    out = np.full((2048, 6), -1, np.int64)
    filled = np.zeros(2048, np.int64)
    for weight in range(5):
        patterns = np.array([sum(1 << b for b in bits) for bits in combinations(range(23), weight)], np.int64)
        for pattern, syndrome in zip(patterns.tolist(), _syndromes(patterns).tolist(), strict=True):
            out[syndrome, filled[syndrome]] = pattern
            filled[syndrome] += 1
    return out


def near_codewords(words: np.ndarray) -> np.ndarray:
    """Indices (12 bits) of the codewords within distance four of 23-bit words; six
    columns, -1 where there are fewer."""
    errors = _errors()[_syndromes(words)]
    return np.where(errors >= 0, (words[:, None] ^ errors) >> 11, -1)


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and keys of unsigned 64-bit fingerprints."""
    parts = [((prints >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
    rows, keys = [], []
    for s, (_, width) in enumerate(SEGMENTS):
        others = [k for k in range(5) if k != s]
        for half, (x, y) in enumerate((others[:2], others[2:])):
            # 12 bits of one segment and 11 of the other: no bit of a pair counts twice
            word = (parts[x] & 0xFFF) << 11 | (parts[y] & 0x7FF)
            index = near_codewords(word)
            row, col = np.nonzero(index >= 0)
            rows.append(row)
            keys.append((s * 2 + half) << 25 | parts[s][row] << 12 | index[row, col])
    return np.concatenate(rows), np.concatenate(keys)


def _few(keys: np.ndarray, prints: np.ndarray, most: int, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links between rows of equal key, for keys of at most ``most`` rows."""
    out = []
    for lag in range(1, most):
        same = np.flatnonzero(keys[lag:] == keys[:-lag])
        if not len(same):
            break
        a, b = prints[same], prints[same + lag]
        close = np.bitwise_count(a ^ b) <= max_bits
        out.append((a[close], b[close]))
    return out


def _forest(prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links of one group."""
    left, found_a, found_b = prints, [], []
    while len(left):
        reach, left = [left[0]], left[1:]
        while reach and len(left):
            at = reach.pop()
            close = np.bitwise_count(left ^ at) <= max_bits
            new = left[close]
            if len(new):
                left = left[~close]
                reach.extend(new)
                found_a.append(np.full(len(new), at))
                found_b.append(new)
    none = prints[:0]
    return np.concatenate([none, *found_a]), np.concatenate([none, *found_b])


LINK_SCHEMA = "a long, b long, big long, chunk long"


def _linker(max_bits: int, limit: int | None):
    """Links among the rows of each key, from rows sorted by key. A key with more than
    ``limit`` rows is handed on instead: big is the key, a the fingerprint."""

    def batch_of(a, b) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"a": a.view(np.int64), "b": b.view(np.int64), "big": pa.nulls(len(a), pa.int64()),
                                           "chunk": pa.nulls(len(a), pa.int64())})

    def handed(key: int, prints: np.ndarray, before: int) -> pa.RecordBatch:
        n = len(prints)
        return pa.RecordBatch.from_pydict({"a": prints.view(np.int64), "b": pa.nulls(n, pa.int64()), "big": np.full(n, key),
                                           "chunk": (before + np.arange(n)) // limit})

    def links(keys: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(first, len(keys)))
        small = np.repeat(sizes <= FEW, sizes)
        pairs = _few(keys[small], prints[small], FEW, max_bits)
        for k in np.flatnonzero(sizes > FEW):
            pairs.append(_forest(prints[first[k]:first[k] + sizes[k]], max_bits))
        if pairs:
            yield batch_of(np.concatenate([a for a, _ in pairs]), np.concatenate([b for _, b in pairs]))

    def run(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_k, held_p = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        large, passed = None, 0  # a key being handed on, and its rows so far
        for batch in found:
            keys, prints = np.asarray(batch.column("key")), np.asarray(batch.column("fp")).view(np.uint64)
            if large is not None:
                more = int(np.searchsorted(keys, large, "right"))
                if more:
                    yield handed(large, prints[:more], passed)
                passed, keys, prints = passed + more, keys[more:], prints[more:]
            if not len(keys):
                continue
            large = None
            keys, prints = np.concatenate([held_k, keys]), np.concatenate([held_p, prints])
            last = int(np.searchsorted(keys, keys[-1]))
            yield from links(keys[:last], prints[:last])
            held_k, held_p = keys[last:], prints[last:]
            if limit is not None and len(held_k) > limit:
                large, passed = int(held_k[0]), len(held_k)
                yield handed(large, held_p, 0)
                held_k, held_p = held_k[:0], held_p[:0]
        yield from links(held_k, held_p)

    return run


def _bucketed(keyed: DataFrame, max_bits: int, limit: int | None) -> DataFrame:
    return keyed.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(_linker(max_bits, limit), LINK_SCHEMA)


def links(prints: DataFrame, max_bits: int = MAX_BITS, chunk: int = CHUNK) -> DataFrame:
    """prints: distinct fingerprints (fp long). Returns links (a, b) that connect exactly
    the fingerprints connected by chains of at most ``max_bits`` differing bits."""
    if max_bits > MAX_BITS:
        raise ValueError(f"the keys are complete up to {MAX_BITS} bits")

    def key(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            every = np.asarray(batch.column("fp"))
            rows, keys = keys_of(every.view(np.uint64))
            yield pa.RecordBatch.from_pydict({"key": keys, "fp": every[rows]})

    first = materialise(_bucketed(prints.select("fp").mapInArrow(key, "key long, fp long"), max_bits, chunk), "golay-links")
    big = first.where("big is not null")
    chunks = big.groupBy("big").agg(F.max("chunk").alias("last"))
    paired = (big.join(chunks, "big").select("big", "chunk", F.col("a").alias("fp"), F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("other"))
              .select(F.xxhash64("big", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("key"), "fp"))
    rest = _bucketed(paired, max_bits, None)
    return first.where("big is null").select("a", "b").union(rest.select("a", "b"))


def _roots(nodes: DataFrame, max_bits: int) -> DataFrame:
    """nodes: distinct fp and more columns. Adds root, the smallest fingerprint of the class."""
    of = components(links(nodes, max_bits)).withColumnRenamed("node", "fp")
    return nodes.join(of, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (hex), component_id for every row."""
    prints = materialise(fingerprints(docs, id_col, text_col, shingle_words), "fingerprints").select("doc_id", "fp")
    roots = _roots(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), max_bits)
    named = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = roots.select("fp", "root").join(named, "root").select("fp", "component_id")
    return (prints.join(classes, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each class, the one with the smallest id, with all its columns.

    Null ids come last; among rows of one id the smallest hash of the text decides, among equal rows any stays."""
    prints = materialise(fingerprints(docs, id_col, text_col, shingle_words), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    roots = _roots(prints.groupBy("fp").agg(F.min(order).alias("least")), max_bits)
    kept = roots.groupBy("root").agg(F.min("least").alias("least")).select(
        F.col("least.doc_id").alias("__id"), F.col("least.text_hash").alias("__hash")).distinct()
    rows, (own_id, text) = by_place(docs, id_col, text_col)
    own = rows.withColumn("__own", F.xxhash64(text))
    found = own.join(kept, F.col(own_id).cast("long").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__hash")))
    one = Window.partitionBy("__id", "__hash").orderBy(text)
    return found.withColumn("__place", F.row_number().over(one)).where("__place = 1").select(*rows.columns).toDF(*docs.columns)


def op5_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))
