"""Benchmark decontamination with SimHash of item-sized windows.

Texts and items are lower-cased and cut to words (runs of letters, digits and ``_``; in scripts
that are written without spaces single letters), so case, punctuation and spacing do not hide a passage. Shingles are five words. A window of a
document is as long as an item (clipped at the ends of the document); it contains the item
when the weighted Jaccard similarity of the two shingle multisets (sum of minima over sum
of maxima) is ``SIMILARITY`` = 0.8 or more.

1. Shingles of the items mark the places of a document where any of them occurs. A window
   that reaches 0.8 must hold, of a shingles in it and m in the item, at least
   0.8 (a + m) / 1.8 marked places. Counting marks in sliding windows leaves exactly the windows
   that can; no window is lost.
2. The 64-bit SimHash of each such window is looked up in a multi-index: eight blocks of
   eight bits. ``RADIUS`` = 20 differing bits leave a block with at most two, so every item of the
   window's length whose fingerprint lies within the radius is a candidate. (Windows at
   similarity 0.8 differ in about 10 of 64 bits, with a standard deviation of 3.)
3. A shingle that repeats can pull a fingerprint beyond any radius. So an item of the window's
   length is also a candidate where the window holds one of the item's rarest shingles, as many
   as a match cannot miss all of. With these no item at 0.8 or more is lost.
4. The exact similarity of the candidates decides.

A word's number is the XXH64 of its bytes, in items and documents alike.

The items are taken in blocks of at most ``BLOCK_WORDS`` words, dealt by a hash, one pass over
the documents for each block, so what a task holds is bounded however large the benchmark
is. Documents are never shuffled.

An item with fewer than five words is one shingle of all its words: a document that has them
in a row contains it. Items without a word match nothing; nor do null texts and items. Repeated items (or ids) match each. Empty tables give no rows."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm.common import by_place, materialise, raw_bytes, table

SHINGLE_WORDS = 5
SIMILARITY = 0.8
RADIUS = 20
BLOCKS = 8  # of 64 / BLOCKS bits
BLOCK_WORDS = 2_000_000
BLOCK_ITEMS = 10_000

_runs = re.compile(r"\w+").findall
# Thai and Lao, Burmese, Khmer, kana, Han
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3031-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
_unspaced = re.compile(f"[{_UNSPACED}]").search
_runs_and_letters = re.compile(rf"[^\W{_UNSPACED}]+|(?=\w)[{_UNSPACED}]").findall


def words_of(text: str) -> list[str]:
    return _runs(text) if text.isascii() or not _unspaced(text) else _runs_and_letters(text)


_MULTIPLIERS = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(SHINGLE_WORDS)], np.uint64)


def word_numbers(words: list[str]) -> np.ndarray:
    """A 64-bit number of each word, the same in every process."""
    parts = "\n".join(words).encode().split(b"\n") if words else []  # no word holds a line end
    return np.fromiter(map(xxhash.xxh64_intdigest, parts), np.uint64, len(parts))


def _mixed(x: np.ndarray) -> np.ndarray:
    """Hash of 64-bit values (multiply and xor-shift rounds)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def simhash(hashes: np.ndarray) -> int:
    """Fingerprint of shingle hashes, repeats counted."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > len(hashes)).tobytes(), "big")


def weighted_jaccard(a: Counter, b: Counter) -> float:
    both = (a & b).total()
    union = a.total() + b.total() - both
    return both / union if union else 0.0


class ItemIndex:
    """Items with their shingles, and the multi-index of their fingerprints."""

    def __init__(self, items: list[tuple[int, str | None]], similarity: float = SIMILARITY, radius: int = RADIUS):
        self.similarity, self.radius = similarity, radius
        self.ids: list[int] = []
        self.counts: list[Counter] = []
        self.short: dict[int, dict[int, list[int]]] = {}  # items by words, and by their only shingle
        prints, lengths, every = [], [], []
        for item_id, text in items:
            words = words_of((text or "").lower())
            if len(words) < SHINGLE_WORDS:
                for h in self.shingles(word_numbers(words), len(words)).tolist() if words else ():
                    self.short.setdefault(len(words), {}).setdefault(h, []).append(item_id)
                continue
            hashes = self.shingles(word_numbers(words))
            self.ids.append(item_id)
            self.counts.append(Counter(hashes.tolist()))
            prints.append(simhash(hashes))
            lengths.append(len(hashes))
            every.append(hashes)
        self.known = np.unique(np.concatenate(every)) if every else np.zeros(0, np.uint64)
        self.known_of = {n: np.unique(np.concatenate([h for h in every if len(h) == n])) for n in sorted({*lengths})}
        self.prints = prints
        width = 64 // BLOCKS
        flips = [0] + [sum(1 << b for b in bits) for n in range(1, radius // BLOCKS + 1) for bits in combinations(range(width), n)]
        self.index: dict[tuple[int, int, int], list[int]] = {}
        for k, (value, length) in enumerate(zip(prints, lengths, strict=True)):
            for block in range(BLOCKS):
                part = value >> (block * width) & ((1 << width) - 1)
                for flip in flips:
                    self.index.setdefault((length, block, part ^ flip), []).append(k)
        holders = Counter((n, h) for n, own in zip(lengths, self.counts, strict=True) for h in own)
        self.rarest: dict[tuple[int, int], list[int]] = {}
        for k, (length, own) in enumerate(zip(lengths, self.counts, strict=True)):
            spare = length - math.ceil(similarity * length - 1e-9)  # shingles that a match may miss
            for h in sorted(own, key=lambda h: (holders[length, h], h)):
                self.rarest.setdefault((length, h), []).append(k)
                spare -= own[h]
                if spare < 0:
                    break

    @staticmethod
    def shingles(word_ids: np.ndarray, size: int = SHINGLE_WORDS) -> np.ndarray:
        """Hash of every five (or ``size``) consecutive words."""
        n = len(word_ids) - size + 1
        if n < 1:
            return np.zeros(0, np.uint64)
        total = np.zeros(n, np.uint64)
        for k in range(size):
            total += word_ids[k:k + n] * _MULTIPLIERS[k]
        return _mixed(total)

    def candidates(self, length: int, value: int) -> list[int]:
        """Items of a length whose fingerprints differ in at most ``radius`` bits."""
        width = 64 // BLOCKS
        found = {k for block in range(BLOCKS)
                 for k in self.index.get((length, block, value >> (block * width) & ((1 << width) - 1)), ())}
        return sorted(k for k in found if (self.prints[k] ^ value).bit_count() <= self.radius)

    def sharing(self, length: int, held: Iterable[int]) -> set[int]:
        """Items of a length that have one of their rarest shingles among those held."""
        return {k for h in held for k in self.rarest.get((length, h), ())}

    def windows(self, every: np.ndarray, hashes: np.ndarray, n: int) -> Iterator[tuple[int, int, int]]:
        """(length, start, stop) of the windows that hold enough shingles of the items of
        their length. every, hashes: the places of item shingles among the document's n
        shingles, and their hashes."""
        for length, known in self.known_of.items():
            least = math.ceil(self.similarity * length)  # shingles that a clipped window needs
            if len(every) < least:
                continue
            marks = every[known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes]
            if len(marks) < least:
                continue
            # a start is worth a look only where a window can reach as many marks
            near = marks[least - 1:] - marks[:len(marks) - least + 1] < length
            if not near.any():
                continue
            first, last = marks[:len(marks) - least + 1][near], marks[least - 1:][near]
            starts = np.unique(np.concatenate([np.arange(b - length + 1, a + 1) for a, b in zip(first, last, strict=True)]))
            begin, end = np.maximum(starts, 0), np.minimum(starts + length, n)
            held = np.searchsorted(marks, end) - np.searchsorted(marks, begin)
            enough = held * (1 + self.similarity) >= self.similarity * (end - begin + length) - 1e-9
            for a, b in dict.fromkeys(zip(begin[enough].tolist(), end[enough].tolist(), strict=True)):
                yield length, a, b

    def matches(self, text: str) -> list[tuple[int, float, int, int, int]]:
        """(item id, similarity, differing bits, first word, words) of each item found: its
        best window, the first of equal ones."""
        numbers = word_numbers(words_of(text.lower()))
        brief = [(k, 1.0, 0, at, n) for n, own in self.short.items()
                 for h, at in self._places(self.shingles(numbers, n), own) for k in own[h]]
        hashes = self.shingles(numbers)
        if not len(hashes) or not len(self.known):
            return brief
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        marks = np.flatnonzero(self.known[at] == hashes)
        best: dict[int, tuple] = {}
        for length, a, b in self.windows(marks, hashes[marks], len(hashes)):
            own = hashes[a:b]
            value = simhash(own)
            counts = Counter(own.tolist())
            for k in {*self.candidates(length, value), *self.sharing(length, counts)}:
                score = weighted_jaccard(counts, self.counts[k])
                if score >= self.similarity and (k not in best or score > best[k][0]):
                    best[k] = (score, (self.prints[k] ^ value).bit_count(), a, b - a + SHINGLE_WORDS - 1)
        return [(self.ids[k], *best[k]) for k in sorted(best)] + brief

    @staticmethod
    def _places(hashes: np.ndarray, wanted: dict[int, list[int]]) -> list[tuple[int, int]]:
        """Those wanted that are among the hashes, and their first places."""
        values, first = np.unique(hashes, return_index=True)
        return [(h, at) for h, at in zip(values.tolist(), first.tolist(), strict=True) if h in wanted]


def item_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[int, str | None]]]:
    """The items, block by block; a block's bytes and items are bounded (an index takes about 7 kB an item)."""
    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    size, count = rows.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    n = max(1, math.ceil((size or 0) / (6 * block_words)), math.ceil(count / BLOCK_ITEMS))
    spread = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for k in range(n):
        yield [tuple(r) for r in rows.where(spread == k).orderBy("item_id", "text").collect()]


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, item_id, similarity, distance, first_word, n_words: one row for each document
    and benchmark item whose passage it holds."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    out = None
    for block in item_blocks(items):
        if out is not None:  # one index at a time: what the blocks before gave is written
            out = materialise(out, "leaks")
        part = rows.mapInArrow(_leak_finder(ItemIndex(block)),
                               f"doc_id {docs.schema[id_col].dataType.simpleString()}, item_id long, similarity double, "
                               "distance int, first_word long, n_words int")
        out = part if out is None else out.union(part)
    return out


def _leak_finder(index: ItemIndex):
    def run(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            ids, hits = [], []
            for row, text in enumerate(batch.column("text")):
                for hit in index.matches((text.as_py() or b"").decode("utf-8", "replace")):
                    ids.append(row)
                    hits.append(hit)
            columns = list(zip(*hits, strict=True)) if hits else [[]] * 5
            kinds = (pa.int64(), pa.float64(), pa.int32(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(ids, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))],
                ["doc_id", "item_id", "similarity", "distance", "first_word", "n_words"])
    return run


def drop_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that hold no benchmark passage, with all their columns."""
    place, names = docs.columns.index(text_col), docs.columns
    docs, _ = by_place(docs)
    for k, block in enumerate(item_blocks(items)):
        if k:
            docs = materialise(docs, "unleaked")
        index = ItemIndex(block)

        def run(found: Iterable[pa.RecordBatch], index: ItemIndex = index) -> Iterator[pa.RecordBatch]:
            for batch in found:
                yield batch.filter(pa.array([not index.matches(raw_bytes(t).decode("utf-8", "replace")) for t in batch.column(place)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs.toDF(*names)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items whose passages they hold."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
