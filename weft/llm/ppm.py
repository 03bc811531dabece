"""Language-model scoring by prediction by partial matching (PPM, escape method D).

A text is scored in a canonical byte form: A-Z lower-cased, its words
``[^\\x20\\x09-\\x0D]+`` each followed by one space, then one end byte 0x0A
(a byte no word can hold).  The context before the first byte is ORDER end bytes.
Every position is therefore one gram: ORDER context bytes and the byte they
predict, packed into one 64-bit integer with the predicted byte lowest.  All
shorter contexts of the trie are suffixes of the grams, so their counts follow
from the gram counts.

The model is pretrained on the training documents.  Symbols seen after a context
are always also seen after its suffix, so exclusion removes exactly the symbols
of the next longer context; the probability of a gram is then a function of the
trie alone, and scoring is a lookup per gram.

How it is spread over the cluster:

1. a block is what one input split holds, cut by a hash to parts of about ``BLOCK_BYTES`` of
   text (the splits' bytes are summed first; rows that come from no file are written to the
   checkpoint folder and read from there); without moving any text each block gives its
   distinct grams and words with their training counts;
2. grams are summed and grouped by the two context bytes before the predicted
   byte: such a group holds every context of length two and more that can matter
   to its grams.  Two bytes that more than ``HEAVY`` rows of the blocks' grams have are
   grouped with the byte before them, and their own contexts' sums go to each of these groups.
   Lengths one and zero come from a table of at most 65,536 sums, the only counts
   the driver collects beside the list of such two bytes;
3. the probabilities join back to the blocks that asked for them, and each block
   meets its documents and scores them (cogroup, the one shuffle of texts).  A task never holds more than one block and
   its distinct grams, whatever the corpus size.

Nulls count as empty texts (one end token).  Repeated rows are scored each on
their own; a null id is scored and never held out.  Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weft.llm.common import by_size, canonical_words, give_back, materialise, table

ORDER = 5
BLOCK_BYTES = 32 << 20
CHUNK_BYTES = 1 << 20
HELD = 2_400_000  # distinct grams that a counting task holds before it gives them out
HEAVY = 4_000_000
END = 0x0A
LOG10 = math.log(10.0)


def canonical(text: bytes | None) -> tuple[bytes, list[bytes]]:
    """The scored bytes of a text and its words."""
    words = canonical_words(text)
    return (b" ".join(words) + b" \n" if words else b"\n"), words


def grams(buffer: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Packed grams of every position from ``order`` on."""
    n = len(buffer) - order
    out = np.zeros(max(n, 0), np.int64)
    for back in range(order + 1):
        out |= buffer[order - back: order - back + n].astype(np.int64) << (8 * back)
    return out


def text_grams(texts: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Grams of several canonical texts and the number of each text's grams.

    Each text is preceded by ``order`` end bytes, and grams that predict one of
    these are left out."""
    pad = bytes([END]) * order
    sizes = np.array([len(t) for t in texts], np.int64)
    buffer = np.frombuffer(pad + pad.join(texts), np.uint8)
    every = grams(buffer, order)
    starts = np.cumsum(sizes + order) - (sizes + order)
    keep = np.ones(len(every), bool)
    for s in range(order):  # predicted byte is padding of the next text
        at = (starts + sizes + s)[:-1]
        keep[at] = False
    return every[keep], sizes


def _sums(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], (np.add.reduceat(weights, first) if len(first) else np.zeros(0, np.int64))


def _find(sorted_keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of ``wanted`` and whether they are there."""
    if not len(sorted_keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(sorted_keys, wanted), len(sorted_keys) - 1)
    return at, sorted_keys[at] == wanted


class Level:
    """Contexts of one length: entries (context, symbol) and the contexts' sums."""

    def __init__(self, entries: np.ndarray, counts: np.ndarray):
        self.entries, self.counts = entries, counts
        context = entries >> 8
        first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(context) else np.zeros(0, np.int64)
        self.first, self.contexts = first, context[first]
        self.total = np.add.reduceat(counts, first) if len(first) else counts[:0]
        self.kinds = np.diff(np.append(first, len(entries)))


def log_probabilities(wanted: np.ndarray, keys: np.ndarray, counts: np.ndarray, low: np.ndarray,
                      order: int = ORDER, second: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Natural log of the PPM probability (a symbol c of n times: (c - 1/2) / n; escape: distinct / 2n), with exclusion, of each wanted gram.

    keys, counts: training grams that share a two-byte context suffix with the
    wanted ones (or all of them). low: 256 x 256 training counts of (previous
    byte, byte), which give the contexts of length one and zero. second: the three-byte
    grams and counts of contexts of length two, where the keys share three bytes."""
    levels: list[Level] = []
    pairs = np.flatnonzero(low.reshape(-1))
    ones = low.sum(axis=0)
    zero = np.flatnonzero(ones)
    levels.append(Level(zero.astype(np.int64), ones[zero]))
    levels.append(Level(pairs.astype(np.int64), low.reshape(-1)[pairs]))
    for k in range(2, order + 1):
        levels.append(Level(*(_sums(*second) if k == 2 and second is not None else _sums(keys & ((1 << (8 * (k + 1))) - 1), counts))))
    # sums, in the next shorter context, over the symbols of each context
    covered: list[np.ndarray] = [np.zeros(0, np.int64)]
    for k in range(1, order + 1):
        own, below = levels[k], levels[k - 1]
        at, there = _find(below.entries, own.entries & ((1 << (8 * k)) - 1))
        part = np.where(there, below.counts[at] if len(below.counts) else 0, 0)
        covered.append(np.add.reduceat(part, own.first) if len(own.first) else part[:0])
    n = len(wanted)
    out, open_ = np.zeros(n), np.ones(n, bool)
    gone, kinds_gone = np.zeros(n), np.zeros(n)  # excluded counts and symbols
    for k in range(order, -1, -1):
        level, key = levels[k], wanted & ((1 << (8 * (k + 1))) - 1)
        if not len(level.entries):
            continue
        c_at, c_there = _find(level.contexts, key >> 8)
        e_at, e_there = _find(level.entries, key)
        total = np.where(c_there, level.total[c_at], 0) - gone
        kinds = np.where(c_there, level.kinds[c_at], 0) - kinds_gone
        live = open_ & c_there & (kinds > 0)
        hit = live & e_there
        out[hit] += np.log((level.counts[e_at[hit]] - 0.5) / total[hit])
        miss = live & ~e_there
        out[miss] += np.log(kinds[miss] / (2 * total[miss]))
        open_ &= ~hit
        if k:
            gone = np.where(c_there, covered[k][c_at], 0)
            kinds_gone = np.where(c_there, level.kinds[c_at], 0)
        else:
            kinds_gone = np.full(n, len(level.entries))
    out[open_] -= np.log(np.maximum(256 - kinds_gone[open_], 1))
    return out


def _tally(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


class Lookup:
    """Values of 64-bit keys: an open-addressed table that is filled and read in array steps."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(1.4 * len(keys)).bit_length())
        size = 1 << self.bits
        self.keys, self.values = np.full(size, -1), np.zeros(size, values.dtype)
        for at in range(0, len(keys), 1 << 18):  # some at a time, so that only the table itself is large
            own, value = keys[at:at + (1 << 18)], values[at:at + (1 << 18)]
            left, spot = np.arange(len(own)), self._spot(own)
            while len(left):
                free = self.keys[spot[left]] == -1
                self.keys[spot[left[free]]] = own[left[free]]  # of several the last one stays
                placed = self.keys[spot[left]] == own[left]
                self.values[spot[left[placed]]] = value[left[placed]]
                left = left[~placed]
                spot[left] = (spot[left] + 1) & (size - 1)

    def _spot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, wanted: np.ndarray) -> np.ndarray:
        """Values of keys that are all there; KeyError if one is not."""
        spot = self._spot(wanted)
        found = self.keys[spot]
        left = np.flatnonzero(found != wanted)
        while len(left):
            if (found[left] == -1).any():
                raise KeyError("a gram has no probability")
            spot[left] = (spot[left] + 1) & ((1 << self.bits) - 1)
            found[left] = self.keys[spot[left]]
            left = left[found[left] != wanted[left]]
        return self.values[spot]


def _chunks(texts, size: int = CHUNK_BYTES):
    """Lists of (row number, canonical text, words), each about ``size`` bytes; a
    text larger than that is a list of its own."""
    part, held = [], 0
    for row, text in enumerate(texts):
        scored, words = canonical(text)
        part.append((row, scored, words))
        held += len(scored)
        if held >= size:
            yield part
            part, held = [], 0
    if part:
        yield part


COUNT_SCHEMA = "block int, gram long, word binary, n long"


class BlockCounts:
    """Distinct grams and words of one block, with their training counts."""

    def __init__(self, order: int):
        self.order, self.seen, self.words, self.held, self.fresh = order, [], Counter(), 0, 0

    def add(self, texts: list[bytes | None], train: bool) -> None:
        for part in _chunks(texts):
            keys, counts = _tally(text_grams([p[1] for p in part], self.order)[0])
            self.seen.append((keys, (counts * train).astype(np.int32)))
            self.held += len(keys)
            self.fresh += len(keys)
            for _, _, own in part:
                if train:
                    self.words.update(own)
                else:
                    self.words.update(dict.fromkeys(own, 0))

    def settle(self) -> None:
        """Bring what is held to distinct grams."""
        self.seen = [self.grams()]
        self.held, self.fresh = len(self.seen[0][0]), 0

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = np.concatenate([k for k, _ in self.seen]), np.concatenate([c for _, c in self.seen])
        self.seen = []
        return _sums(keys, counts)

    def rows(self, block: int) -> Iterator[pa.RecordBatch]:
        keys, counts = self.grams()
        for at in range(0, len(keys), 1 << 16):
            some = slice(at, at + (1 << 16))
            n = len(keys[some])
            yield pa.RecordBatch.from_pydict({"block": np.full(n, block, np.int32), "gram": keys[some],
                                              "word": pa.nulls(n, pa.binary()), "n": counts[some].astype(np.int64)})
        words = list(self.words.items())
        for at in range(0, len(words), 1 << 16):
            some = words[at:at + (1 << 16)]
            yield pa.RecordBatch.from_pydict({
                "block": np.full(len(some), block, np.int32), "gram": pa.nulls(len(some), pa.int64()),
                "word": pa.array([w for w, _ in some], pa.binary()), "n": pa.array([c for _, c in some], pa.int64())})


def _counter(order: int):
    def count(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, BlockCounts] = {}
        for batch in found:
            for part in by_size(batch, "text", 2 * CHUNK_BYTES):
                own = part.column("block").to_pylist()
                held = part.column("held_out").to_pylist()
                texts = part.column("text").to_pylist()
                split: dict[tuple[int, bool], list] = {}
                for block, out, text in zip(own, held, texts, strict=True):
                    split.setdefault((block, out), []).append(text)
                for (block, out), some in split.items():
                    blocks.setdefault(block, BlockCounts(order)).add(some, not out)
                if sum(b.fresh for b in blocks.values()) > HELD // 4:
                    for counts in blocks.values():
                        counts.settle()
                    if sum(b.held for b in blocks.values()) > HELD:  # a block may give a gram more than once
                        for block in list(blocks):
                            yield from blocks.pop(block).rows(block)
        for block in list(blocks):
            yield from blocks.pop(block).rows(block)
        give_back()
    return count


def _modeller(low: np.ndarray, order: int):
    def model(rows: pa.Table) -> pa.Table:
        every, n = np.asarray(rows.column("gram")), np.asarray(rows.column("n"))
        sums = np.asarray(rows.column("sums"))
        second = (every[sums], n[sums]) if sums.any() else None
        every, n = every[~sums], n[~sums]
        known = n > 0
        keys, counts = _sums(every[known], n[known])
        return pa.table({"gram": every, "value": (log_probabilities(every, keys, counts, low, order, second) / LOG10).astype(np.float32)})
    return model


def _grouped(counted: DataFrame, crowded: list[int]) -> DataFrame:
    """Distinct grams (gram, n) with the ``group`` whose trie they need; for ``crowded`` pairs of
    context bytes each group of three bytes has the sums of the two as well (``sums``)."""
    pair = F.shiftright("gram", 8).bitwiseAND(0xFFFF)
    rows = counted.select("gram", "n", F.lit(False).alias("sums"))
    if not crowded:
        return rows.withColumn("group", pair)
    third = F.shiftright("gram", 8).bitwiseAND(0xFFFFFF) + (1 << 24)
    own = counted.where(pair.isin(crowded))
    around = own.groupBy(pair.alias("pair")).agg(F.collect_set(third).alias("groups"))  # 256 at most
    sums = (own.where("n > 0").groupBy(F.col("gram").bitwiseAND(0xFFFFFF).alias("gram")).agg(F.sum("n").alias("n"))
               .join(F.broadcast(around), pair == F.col("pair"))  # one row for each heavy pair
               .select("gram", "n", F.lit(True).alias("sums"), F.explode("groups").alias("group")))
    return rows.withColumn("group", F.when(pair.isin(crowded), third).otherwise(pair)).unionByName(sums)


SCORE_COLUMNS = "held_out boolean, n_tokens long, n_known long, base_part double, score double, kinds long"


def _scorer(order: int, end_count: int):
    def score(docs: pa.Table, lookup: pa.Table) -> pa.Table:
        value = np.asarray(lookup.column("value"))
        is_gram = np.asarray(lookup.column("gram").is_valid())
        logs = Lookup(np.asarray(lookup.column("gram").drop_null()), value[is_gram].astype(np.float32))
        count_of = dict(zip(lookup.column("word").drop_null().to_pylist(), value[~is_gram].tolist(), strict=True)).__getitem__
        n = len(docs)
        out = {"n_tokens": np.zeros(n, np.int64), "n_known": np.zeros(n, np.int64),
               "base_part": np.zeros(n), "score": np.zeros(n)}
        for part in _chunks(x.as_py() for x in docs.column("text")):
            rows = np.array([p[0] for p in part])
            own, sizes = text_grams([p[1] for p in part], order)
            out["score"][rows] = np.add.reduceat(logs(own).astype(np.float64), np.cumsum(sizes) - sizes)
            sizes = np.array([len(p[2]) + 1 for p in part])
            first = np.cumsum(sizes) - sizes
            counts = np.full(sizes.sum(), float(end_count))
            inside = np.ones(len(counts), bool)
            inside[first] = False  # the end token's place; the order does not matter
            counts[inside] = np.fromiter(chain.from_iterable(map(count_of, p[2]) for p in part), np.float64, int(inside.sum()))
            out["n_tokens"][rows] = sizes
            out["n_known"][rows] = np.add.reduceat((counts > 0).astype(np.int64), first)
            out["base_part"][rows] = np.add.reduceat(np.log10(counts + 0.5), first)
        kinds = np.zeros(n, np.int64)
        if n:  # words that this block tells of, on one of its rows
            kinds[0] = np.asarray(lookup.column("first").cast(pa.int64()).fill_null(0)).sum()
        found = pa.table({"doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"), **out, "kinds": kinds})
        del docs, lookup, logs, count_of
        give_back()
        return found
    return score


def _blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Adds block: of an input split, cut by a hash to parts of ``block_bytes`` of text."""
    def placed(rows: DataFrame) -> DataFrame:
        name = F.input_file_name()
        return rows.withColumn("__split", F.when(name != "", F.xxhash64(name, F.input_file_block_start())))

    rows = placed(docs)
    if rows.where("__split is null").limit(1).count():  # from memory or a shuffle: there are no splits yet
        rows = placed(materialise(docs, "ppm-texts"))
    sizes = (rows.groupBy(F.col("__split").alias("__of")).agg(F.ceil(F.sum(F.octet_length("text")) / block_bytes).cast("long").alias("__parts"))
                 .where("__parts > 1"))  # one row for an input split, at most
    part = F.pmod(F.xxhash64("doc_id", "text"), F.coalesce("__parts", F.lit(1)))
    return (rows.join(F.broadcast(sizes), F.col("__split") == F.col("__of"), "left")
                .withColumn("block", F.hash("__split", part)).drop("__split", "__of", "__parts"))


def score_texts(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text",
                order: int = ORDER, block_bytes: int = BLOCK_BYTES, heavy: int = HEAVY) -> DataFrame:
    """Score every text with a model learned from the rows where ``held_out`` is not true.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (unigram)
    and score (PPM), both log10 probabilities."""
    rows = _blocks(docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"),
                               F.coalesce(held_out, F.lit(False)).alias("held_out")), block_bytes)
    n_train = rows.where("not held_out").count()
    counted = materialise(rows.select("block", "held_out", "text").mapInArrow(_counter(order), COUNT_SCHEMA), "ppm-counts", "zstd")
    # one exchange: the sums and the blocks' own rows read the same columns of it
    asked = counted.where("gram is not null").select("block", "gram", "n").repartition("gram")
    words = counted.where("word is not null").select("block", "word", "n")

    low = np.zeros((256, 256), np.int64)
    for pair, n in (counted.where("gram is not null").groupBy(F.col("gram").bitwiseAND(0xFFFF).alias("pair")).agg(F.sum("n")).collect()):
        low[pair >> 8, pair & 255] = n  # 65,536 sums at most
    distinct = (asked.groupBy("gram").agg(F.sum("n").alias("n"), F.max("block").alias("block")).where("block is not null")
                .select("gram", "n"))
    pairs = counted.where("gram is not null").groupBy(F.shiftright("gram", 8).bitwiseAND(0xFFFF).alias("pair")).count()
    crowded = [r.pair for r in pairs.where(F.col("count") > heavy).select("pair").collect()]  # 65,536 at most
    model = _grouped(distinct, crowded).groupBy("group").applyInArrow(_modeller(low, order), "gram long, value float")
    # n is kept on this side too (a filter on it would go below the exchange and make another one)
    found = asked.join(model, "gram").withColumn("value", F.when(F.col("n") >= 0, F.col("value")))
    word = Window.partitionBy("word")
    total = (words.withColumn("value", F.sum("n").over(word)).withColumn("place", F.row_number().over(word.orderBy("block")))
             .select("block", F.lit(None).cast("long").alias("gram"), "word", F.col("value").cast("double").alias("value"),
                     ((F.col("place") == 1) & (F.col("value") > 0)).alias("first")))
    lookup = found.select("block", "gram", F.lit(None).cast("binary").alias("word"), F.col("value").cast("double").alias("value"),
                          F.lit(None).cast("boolean").alias("first")).unionByName(total)
    id_type = docs.schema[id_col].dataType.simpleString()
    scored = materialise(rows.groupBy("block").cogroup(lookup.groupBy("block"))
                         .applyInArrow(_scorer(order, n_train), f"doc_id {id_type}, {SCORE_COLUMNS}"), "ppm-scores")
    tokens, kinds = words.agg(F.sum("n")).first()[0], scored.agg(F.sum("kinds")).first()[0]
    tokens = (tokens or 0) + n_train
    scale = tokens + 0.5 * ((kinds or 0) + (n_train > 0) + 1)  # N + 0.5 (V + 1)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
                         (F.col("base_part") - F.col("n_tokens") * F.lit(math.log10(scale))).alias("base_score"), "score")


def op2_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PPM and unigram scores of every document, learned from those with crc32(doc_id) mod 5 not 1."""
    docs = table(spark, sf_dir, "documents")
    return score_texts(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1)
