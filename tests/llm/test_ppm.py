"""PPM scores against a trie of dictionaries."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weft.llm import ppm

def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1


def _held(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def brute(docs, order=ppm.ORDER):
    trie, counts, n = defaultdict(Counter), Counter(), 0
    pad = b"\n" * order
    canon = [(i, *ppm.canonical(None if t is None else t.encode())) for i, t in docs]
    for i, text, words in canon:
        if _held(i):
            continue
        counts.update([*words, None])
        whole = pad + text
        for at in range(order, len(whole)):
            for k in range(order + 1):
                trie[whole[at - k:at]][whole[at]] += 1
    n, kinds = counts.total(), len(counts)

    def symbol(context: bytes, s: int) -> float:
        out, gone = 0.0, set()
        for k in range(order, -1, -1):
            seen = {a: c for a, c in trie.get(context[order - k:], {}).items() if a not in gone}
            if not seen:
                continue
            total = sum(seen.values())
            if s in seen:
                return out + math.log10((seen[s] - 0.5) / total)
            out += math.log10(len(seen) / (2 * total))
            gone |= set(seen)
        return out - math.log10(max(256 - len(gone), 1))

    rows = []
    for i, text, words in canon:
        whole = pad + text
        rows.append((i, _held(i), len(words) + 1, sum(counts[w] > 0 for w in [*words, None]), n,
                     sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (kinds + 1))) for w in [*words, None]),
                     sum(symbol(whole[at - order:at], whole[at]) for at in range(order, len(whole)))))
    return rows


def _check(got, want):
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[6])
    assert len(got) == len(want)
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert tuple(a[:5]) == tuple(b[:5])
        assert a[5] == pytest.approx(b[5], rel=1e-9) and a[6] == pytest.approx(b[6], rel=1e-5)


DOCS = [(1, "The cat sat on the mat. The END"), (2, None), (3, ""), (4, "the cat sat"), (5, "the cat sat"), (5, "the cat sat"),
        (6, "a" * 3000), (7, "Ünïcode wörds\tand\nlines  the"), (8, "xyzzy unseen"), (None, "no id here"), (11, "the dog sat on the cat " * 40)]


@pytest.mark.parametrize("from_file", [True, False])
def test_scores_equal_the_brute_force(spark, tmp_path, from_file):
    df = spark.createDataFrame([(i, t, 1.5, 2) for i, t in DOCS], "doc_id long, text string, score double, block int").repartition(3)
    if from_file:
        df.write.parquet(str(tmp_path / "d"))
        df = spark.read.parquet(str(tmp_path / "d"))
    _check(ppm.score_texts(df, held_out()).collect(), brute(DOCS))


def test_small_blocks_and_chunks_give_the_same(spark, monkeypatch):
    df = spark.createDataFrame(DOCS, "doc_id long, text string")
    _check(ppm.score_texts(df, held_out(), block_bytes=500).collect(), brute(DOCS))


@pytest.mark.parametrize("heavy", [0, 3, 40])
def test_heavy_contexts_give_the_same(spark, heavy):
    df = spark.createDataFrame(DOCS, "doc_id long, text string")
    _check(ppm.score_texts(df, held_out(), heavy=heavy).collect(), brute(DOCS))


def test_counts_given_out_early_give_the_same(spark, monkeypatch):
    found = []
    rows = [pa.RecordBatch.from_pydict({"block": [k % 3], "held_out": [False], "text": [(t or "").encode()]}) for k, (_, t) in enumerate(DOCS)]
    for held in (ppm.HELD, 40):
        monkeypatch.setattr(ppm, "HELD", held)
        total = Counter()
        batches = list(ppm._counter(ppm.ORDER)(rows))
        for b in batches:
            for block, gram, word, n in zip(*[b.column(c).to_pylist() for c in ("block", "gram", "word", "n")], strict=True):
                total[block, gram, word] += n
        found.append((total, len(batches)))
    assert found[0][0] == found[1][0] and found[1][1] > found[0][1]


def test_blocks_have_their_size_whatever_the_rows_come_from(spark, tmp_path):
    rows = [(k, ("word%d " % k) * 40) for k in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.coalesce(1).write.parquet(str(tmp_path / "d"))
    read = spark.read.parquet(str(tmp_path / "d"))
    for some in (read, read.repartition(4), read.join(df.select("doc_id").distinct(), "doc_id"), df):
        sizes = ppm._blocks(some.select("doc_id", F.col("text").cast("binary").alias("text")), 20_000).groupBy("block").agg(F.sum(F.length("text")).alias("n"), F.count("*").alias("rows")).collect()
        assert sum(r.rows for r in sizes) == 600 and len(sizes) >= 6 and max(r.n for r in sizes) < 60_000
    _check(ppm.score_texts(read.where("doc_id < 12").repartition(4), held_out(), block_bytes=800).collect(), brute(rows[:12]))


def test_empty_table_and_no_training_rows(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, text string")
    assert ppm.score_texts(df.where("false"), held_out()).collect() == []
    (r,) = ppm.score_texts(df.where("doc_id = 4"), F.lit(True)).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (4, 0, 0)
    assert r.score == pytest.approx(-math.log10(256) * len("the cat sat \n"), rel=1e-5)


def test_probabilities_sum_to_one():
    texts = [b"the cat the hat \n", b"cat hat bat \n"]
    keys, counts = ppm._tally(ppm.text_grams(texts)[0])
    low = np.zeros((256, 256), np.int64)
    np.add.at(low.reshape(-1), keys & 0xFFFF, counts)
    for context in (b" the ", b"e hat", b"zzzzz", b"cat t"):
        base = int.from_bytes(context, "big") << 8
        logs = ppm.log_probabilities(base + np.arange(256), keys, counts, low)
        assert np.exp(logs).sum() == pytest.approx(1.0)


def test_lookup_table():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 48, 5000))
    table = ppm.Lookup(keys, keys.astype(float) + 1)
    some = rng.choice(keys, 9000)
    assert (table(some) == some + 1.0).all()
    with pytest.raises(KeyError):
        table(np.array([-5]))
