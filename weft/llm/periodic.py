"""Periodic runs: stretches of a text's words that repeat with a period.

A run is a stretch of consecutive words whose smallest period is q (words q apart are
equal), of at least ``max(LEAST, 2 q)`` words, that no neighbouring word extends.

Scale-tiled distribution. Periods are handled by octaves, those from 2^o to 2^(o+1) - 1
together. In an octave, boundaries stand every ``spacing`` words, so close that every run
of such a period covers a boundary and one period after it. Around a boundary lies a tile
that reaches one longest period back and two ahead; neighbouring tiles overlap by more
than a period. A tile is solved alone: the Z-function of the words after the boundary and
that of the words before it (reversed) say how far the text agrees with itself one period
on, in both directions, so every repetition through the boundary is found in time linear
in the tile. Fragments of one document and period are then brought together and those that
overlap by a period or more are one run; this is all that is shuffled, beside the text of
documents that have runs.

Most tiles hold nothing: a repetition agrees over half its minimal length on one side of
its boundary, so tiles are first tested with rolling hashes, all of a batch at once. Equal
hashes only send a tile to its Z-functions, which compare the words themselves.

Documents of up to ``TILE`` words are solved where they are read. Longer ones are exploded
into overlapping spans of tiles, all octaves below ``WIDE`` together and each wider one
in its own, and the spans are dealt over all tasks, so a document of any length is spread.

Words are cut at ASCII white space; null and empty texts have none. Rows are told apart by
their place in the scan, so repeated rows and null ids are rows of their own. An empty
table gives no rows. Other columns are left alone, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from weft.llm.common import by_size, materialise, raw_bytes, table

LEAST = 12            # words of the shortest run
TILE = 1 << 16        # words of a span's core
WIDE = 11             # octaves from this on have spans of their own
BATCH_BYTES = 4 << 20
PAIRS = 1 << 18       # (boundary, period) pairs that are tested at a time
_FACTOR = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def octaves(n: int) -> int:
    """How many octaves have periods that fit ``n`` words twice."""
    return (n // 2).bit_length() if n >= LEAST else 0


def spacing(octave: int) -> int:
    """Words between boundaries: a run has more than this many words in which a period can start."""
    return 8 if octave < 2 else 1 << octave


def reach(octave: int) -> tuple[int, int]:
    """Words of a tile before and after its boundary."""
    longest = 2 << octave
    return max(longest, LEAST), max(2 * longest, 2 * LEAST)


def agreeing(octave: int) -> int:
    """Words over which a run agrees with itself on one side of a boundary, at least."""
    return min(-(-(max(LEAST, 2 * q) - q) // 2) for q in range(1 << octave, min(2 << octave, LEAST + (1 << octave))))


class Span(NamedTuple):
    """Words ``ids`` of a document from place ``base`` on, to be solved for the boundaries in
    [``start``, ``stop``) and the octaves in [``low``, ``high``); the document has ``n`` words."""

    row: int
    n: int
    base: int
    start: int
    stop: int
    low: int
    high: int
    ids: np.ndarray


def spans(row: int, ids: np.ndarray, tile: int = TILE, wide: int = WIDE) -> Iterator[Span]:
    """A document as spans whose cores follow one another in each octave."""
    n, top = len(ids), octaves(len(ids))
    if n <= tile and top:
        yield Span(row, n, 0, 0, n, 0, top, ids)
    if n <= tile or not top:
        return
    for low, high in [(0, min(wide, top)), *[(o, o + 1) for o in range(wide, top)]]:
        before, after = reach(high - 1)
        core = max(tile, 32 << (high - 1))
        for start in range(0, n, core):
            stop = min(start + core, n)
            base = max(0, start - before)
            yield Span(row, n, base, start, stop, low, high, ids[base:stop + after])


def z_function(s: list[int], size: int) -> list[int]:
    """For each of the first ``size`` places, how many elements from there on equal the beginning."""
    n = len(s)
    z = [0] * size
    z[0] = n
    left = right = 0
    for i in range(1, size):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def solve_tile(words: list[int], pivot: int, periods: list[int]) -> Iterator[tuple[int, int, int]]:
    """Repetitions (start, stop, period) through the boundary before ``words[pivot]``, of the given
    periods where they are the smallest."""
    longest = max(periods)
    ahead = words[pivot:]
    forward = z_function(ahead, min(longest + 1, len(ahead)))
    head, tail = words[:pivot][::-1], words[:pivot + longest][::-1]
    whole = len(head) + 1 + len(tail) - pivot  # of a period zero
    backward = z_function([*head, -1 << 40, *tail], whole)
    for q in periods:
        f = forward[q] if q < len(forward) else 0
        g = backward[whole - q] if head else 0
        if f + g + q >= max(LEAST, 2 * q) and not any(q % d == 0 and forward[d] >= q - d for d in range(1, q // 2 + 1)):
            yield pivot - g, pivot + q + f, q


def fragments(found: list[Span]) -> Iterator[tuple[int, int, int, int]]:
    """(row, period, start, stop) of what the tiles of some spans hold; the places are the document's."""
    if not found:
        return
    sizes = np.array([len(s.ids) for s in found])
    offs = np.cumsum(sizes + 1) - sizes  # a mark before each span and one after the last
    flat = np.empty(int(sizes.sum()) + len(found) + 1, np.int64)
    flat[offs - 1] = -1 - np.arange(len(found))
    flat[-1] = -1 - len(found)
    for span, off in zip(found, offs.tolist(), strict=True):
        flat[off:off + len(span.ids)] = span.ids
    with np.errstate(over="ignore"):
        code = flat.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9) + _FACTOR
        code = (code ^ code >> np.uint64(29)) * np.uint64(0x94D049BB133111EB)
        code ^= code >> np.uint64(32)
        powers = np.concatenate([[np.uint64(1)], np.full(len(flat), _FACTOR)]).cumprod(dtype=np.uint64)
        undo = np.concatenate([[np.uint64(1)], np.full(len(flat), _INVERSE)]).cumprod(dtype=np.uint64)
        sums = np.concatenate([[np.uint64(0)], (code * powers[:-1]).cumsum(dtype=np.uint64)])
    base, start, stop, n = (np.array([getattr(s, a) for s in found]) for a in ("base", "start", "stop", "n"))
    low, high = np.array([s.low for s in found]), np.array([s.high for s in found])
    seen: set[tuple[int, int, int, int]] = set()
    for octave in range(int(low.min()), int(high.max())):
        step, shortest, window = spacing(octave), 1 << octave, agreeing(octave)
        first = -(-start // step) * step
        last = np.minimum(stop, n - shortest + 1)
        many = np.where((low <= octave) & (octave < high), np.maximum(0, -(-(last - first) // step)), 0)
        if not many.any():
            continue
        own = np.repeat(np.arange(len(found)), many)
        places = (first + offs - base)[own] + step * (np.arange(len(own)) - np.repeat(np.cumsum(many) - many, many))
        ends = (offs + sizes)[own]
        with np.errstate(over="ignore"):
            hashes = (sums[window:] - sums[:-window]) * undo[:len(sums) - window]
        top = len(hashes) - 1
        periods = np.arange(shortest, 2 * shortest)
        rows = max(1, PAIRS // shortest)
        for at in range(0, len(places), rows):
            b = places[at:at + rows, None]
            for q0 in range(0, shortest, PAIRS):
                q = periods[None, q0:q0 + PAIRS]
                other = b + q
                hit = hashes[np.minimum(other, top)] == hashes[np.minimum(b, top)]
                hit |= hashes[np.clip(other - window, 0, top)] == hashes[np.clip(b - window, 0, top)]
                hit &= other <= ends[at:at + rows, None]
                if hit.any():
                    yield from _checked(found, offs, flat, own[at:at + rows], places[at:at + rows], hit, periods[q0:q0 + PAIRS], octave, seen)


def _checked(found, offs, flat, own, places, hit, periods, octave, seen):
    """Solve the tiles that have hits; each fragment once."""
    before, after = reach(octave)
    for k in np.flatnonzero(hit.any(axis=1)).tolist():
        span = found[own[k]]
        off, b = int(offs[own[k]]), int(places[k])
        left, right = max(off, b - before), min(off + len(span.ids), b + after)
        shift = span.base - off
        for start, stop, q in solve_tile(flat[left:right].tolist(), b - left, periods[hit[k]].tolist()):
            fragment = (span.row, q, left + start + shift, left + stop + shift)
            if fragment not in seen:
                seen.add(fragment)
                yield fragment


READ = ("row long, id {id}, n long, words_sha256 string, words binary, period long, start long, stop long, "
        "base long, low int, high int, ids binary")
HEAD, FRAGMENT, SPAN = ("row", "id", "n", "words_sha256", "words"), ("row", "period", "start", "stop"), ("row", "n", "base", "start", "stop", "low", "high", "ids")


def _read(tile: int, id_type: pa.DataType):
    """Heads of documents, fragments of the short ones and spans of the long ones."""
    kinds = pa.schema([("row", pa.int64()), ("id", id_type), ("n", pa.int64()), ("words_sha256", pa.string()), ("words", pa.binary()),
                       ("period", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("base", pa.int64()),
                       ("low", pa.int32()), ("high", pa.int32()), ("ids", pa.binary())])

    def rows(names, values) -> pa.RecordBatch:
        columns = dict(zip(names, map(list, zip(*values, strict=True)), strict=True))
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(len(values), f.type)
                                           for f in kinds], schema=kinds)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in by_size(batch, "text", BATCH_BYTES):
                number: dict[bytes, int] = defaultdict(count().__next__)
                heads, short = [], []
                for row, doc_id, text in zip(part.column("row").to_pylist(), part.column("id").to_pylist(), part.column("text"), strict=True):
                    words = raw_bytes(text).split()
                    joined = b" ".join(words)
                    heads.append([row, doc_id, len(words), hashlib.sha256(joined).hexdigest(), joined])
                    ids = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
                    if len(words) <= tile:
                        short.extend(spans(row, ids, tile))
                    else:
                        for s in spans(row, ids, tile):
                            yield rows(SPAN, [(*s[:7], s.ids.tobytes())])
                have = list(fragments(short))
                with_runs = {f[0] for f in have}
                for head in heads:
                    head[4] = pack.compress(head[4]) if head[0] in with_runs or head[2] > tile else None
                yield rows(HEAD, heads)
                if have:
                    yield rows(FRAGMENT, have)

    return run


def _solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in by_size(batch, "ids", BATCH_BYTES):
            some = [Span(*own, np.frombuffer(raw_bytes(ids), np.int32))
                    for *own, ids in zip(*[part.column(c).to_pylist() for c in SPAN[:7]], part.column("ids"), strict=True)]
            have = list(fragments(some))
            if have:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*have, strict=True)], names=list(FRAGMENT))


def stitch(found: DataFrame) -> DataFrame:
    """Runs (row, period, start, length) of fragments (row, period, start, stop): those of one
    period that overlap by a period or more belong together."""
    in_order = Window.partitionBy("row", "period").orderBy("start", "stop")
    until = F.max("stop").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    cut = found.withColumn("fresh", F.when(until - F.col("start") >= F.col("period"), 0).otherwise(1))
    cut = cut.withColumn("run", F.sum("fresh").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    return (cut.groupBy("row", "period", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
               .select("row", "period", "start", (F.col("stop") - F.col("start")).alias("length")))


def _collapse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        for at in range(len(batch)):
            part = batch.slice(at, 1)
            runs = part.column("runs")[0].as_py() or []
            kept = None
            if runs:
                words = unpack.decompress(part.column("words")[0].as_py()).split(b" ")
                depth = np.zeros(len(words) + 1, np.int64)
                np.add.at(depth, [r["start"] + r["period"] for r in runs], 1)
                np.add.at(depth, [r["start"] + r["length"] for r in runs], -1)
                kept = b" ".join([words[k] for k in np.flatnonzero(depth.cumsum()[:-1] == 0).tolist()])
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in ("row", "id", "n", "words_sha256", "runs")],
                                              pa.array([kept], pa.binary())], names=["row", "id", "n", "words_sha256", "runs", "collapsed"])


RUNS = "array<struct<start:bigint,period:bigint,length:bigint>>"


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile: int = TILE) -> DataFrame:
    """id, n (words), words_sha256 (of the words joined by spaces), runs (by start, then
    period) and collapsed of every row: the words without those that a run holds after its
    first period, joined by spaces; null where there are no runs."""
    kind = docs.schema[id_col].dataType
    text = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    from pyspark.sql.pandas.types import to_arrow_type

    read = materialise(text.mapInArrow(_read(tile, to_arrow_type(kind)), READ.format(id=kind.simpleString())), "periodic", "zstd")
    shipped = read.where("ids IS NOT NULL").select(*SPAN).repartition("row", "low", "base")
    found = (read.where("period IS NOT NULL").select(*FRAGMENT)
                 .unionByName(shipped.mapInArrow(_solve, "row long, period long, start long, stop long")))
    runs = stitch(found).groupBy(F.col("row").alias("of")).agg(
        F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    heads = read.where("words_sha256 IS NOT NULL").select(*HEAD)
    some = heads.where("words IS NOT NULL").join(runs, F.col("row") == F.col("of"), "left").drop("of")
    shape = f"row long, id {kind.simpleString()}, n long, words_sha256 string, runs {RUNS}, collapsed binary"
    none = heads.where("words IS NULL").select("row", "id", "n", "words_sha256", F.array().cast(RUNS).alias("runs"),
                                               F.lit(None).cast("binary").alias("collapsed"))
    return (some.mapInArrow(_collapse, shape).unionByName(none)
                .select(F.col("id").alias(id_col), "n", "words_sha256", F.coalesce("runs", F.array().cast(RUNS)).alias("runs"), "collapsed"))


def planted(doc_id: Column, text: Column) -> Column:
    """The text, of one document in ten with a tail that repeats: word i from a on becomes word a + (i - a) mod p."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def repeated(x: Column) -> Column:  # x: words w, their number n and the place a
        p = 1 + F.floor((x["n"] - x["a"]) / (3 + g % 8))
        return F.array_join(F.transform(x["w"], lambda w, i: F.get(x["w"], F.when(i >= x["a"], x["a"] + (i - x["a"]) % p).otherwise(i).cast("int"))), " ")

    sized = F.transform(F.array(words), lambda w: F.struct(w.alias("w"), F.size(w).alias("n"), (g % F.greatest(F.size(w), F.lit(1))).alias("a")))
    tail = F.when(F.size(words) > 0, F.get(F.transform(sized, repeated), F.lit(0)))
    return F.when(h % 10 == 0, tail).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of the words of ``documents``, with digests of the runs and of the collapsed texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs(docs)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return (found.withColumn("best", best)
                 .select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
                         (-F.col("best.period")).alias("period"),
                         F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"),
                         F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
                         F.coalesce(F.sha2("collapsed", 256), F.col("words_sha256")).alias("collapsed_sha256")))
