"""Periodic runs against a direct search over all periods."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weft.llm import periodic
from weft.llm.periodic import LEAST, Span, fragments, octaves, periodic_runs, spans


def brute(words):
    """Sorted (start, period, length) of all runs."""
    found, n = [], len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            root = words[i:i + q]
            if j + q - i >= max(LEAST, 2 * q) and not any(q % d == 0 and root == root[:d] * (q // d) for d in range(1, q)):
                found.append((i, q, j + q - i))
            i = j
    return sorted(found)


def collapsed(words, runs):
    drop = set()
    for s, q, n in runs:
        drop.update(range(s + q, s + n))
    return [w for k, w in enumerate(words) if k not in drop]


def joined(parts):
    """Runs of fragments (period, start, stop)."""
    out = []
    for q, s, e in sorted(parts):
        if out and out[-1][0] == q and out[-1][2] - s >= q:
            out[-1][2] = max(out[-1][2], e)
        else:
            out.append([q, s, e])
    return sorted((s, q, e - s) for q, s, e in out)


def solved(words, **how):
    number = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int32)
    return joined({f[1:] for f in fragments(list(spans(0, ids, **how)))})


def periodic_words(rng, n):
    words = []
    while len(words) < n:
        kind = rng.random()
        if kind < 0.3:
            words += [rng.choice("abcdefgh") for _ in range(rng.randint(1, 20))]
        else:
            unit = [rng.choice("abc" if kind < 0.6 else "abcdefghijklmnop") for _ in range(rng.randint(1, 40))]
            words += (unit * 12)[:rng.randint(1, 6 * len(unit))]
    return words[:n]


def test_every_octave_has_its_bounds():
    for o in range(12):
        before, after = periodic.reach(o)
        for q in range(1 << o, 2 << o):
            least = max(LEAST, 2 * q)
            assert periodic.spacing(o) <= least - q + 1 and 2 * periodic.agreeing(o) - 1 <= least - q
            assert before >= max(q, periodic.spacing(o)) and after - q >= max(q, periodic.spacing(o)) and before + after - periodic.spacing(o) >= q
    assert [octaves(n) for n in (0, 11, 12, 15, 16, 31, 32)] == [0, 0, 3, 3, 4, 4, 5]


def test_solver_against_direct_search_with_and_without_tiles():
    rng = random.Random(3)
    for k in range(150):
        words = periodic_words(rng, rng.choice([0, 5, 11, 12, 13, 24, 60, 200, 500]))
        want = brute(words)
        assert solved(words) == want, k
        assert solved(words, tile=16, wide=2) == want, k


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=80))
def test_two_letter_words(words):
    assert solved(words) == brute(words) == solved(words, tile=8, wide=1)


def test_one_batch_of_many_documents_keeps_them_apart():
    rng = random.Random(5)
    docs = [periodic_words(rng, rng.randint(0, 120)) for _ in range(60)]
    docs += [docs[3]] * 5
    number = {}
    every = [s for k, d in enumerate(docs) for s in spans(k, np.array([number.setdefault(w, len(number)) for w in d], np.int32))]
    parts = {}
    for row, q, s, e in fragments(every):
        parts.setdefault(row, set()).add((q, s, e))
    assert [joined(parts.get(k, ())) for k in range(len(docs))] == [brute(d) for d in docs]


def test_equal_words_in_linear_time():
    n = 200_000
    assert solved(["x"] * n) == [(0, 1, n)]
    assert [tuple(f) for f in fragments([Span(0, 0, 0, 0, 0, 0, 0, np.array([], np.int32))])] == []


def contract(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute(words)
    best = max(((m, -s, -q) for s, q, m in runs), default=None)
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return (doc_id, len(runs), *((-best[1], best[0], -best[2], 1000 * best[0] // -best[2]) if best else (None,) * 4),
            sha(b"".join(b"%d,%d,%d\n" % (s, m, q) for s, q, m in runs)), sha(b" ".join(collapsed(words, runs))))


def test_query_against_direct_search(spark, tmp_path):
    rng = random.Random(7)
    rows = [(k, " ".join(periodic_words(rng, rng.randint(0, 150)))) for k in range(150)]
    rows += [(k, "  one\ttwo\x0bthree four\n" * (k % 9)) for k in range(300, 330)]
    rows += [(5, rows[5][1]), (None, "a b " * 20), (700, None), (701, ""), (702, " \n"), (704, "w " * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit("x")).withColumn("period", F.lit("x"))
    df.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((tuple(r) for r in periodic.op13_periodic_runs(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted((contract(*r) for r in rows), key=str)
    assert any(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows if r[1])


def test_long_documents_are_spread(spark):
    rng = random.Random(9)
    rows = [(k, " ".join(periodic_words(rng, 1500))) for k in range(4)] + [(9, "short text"), (10, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in periodic_runs(df, tile=100).collect()}
    for k, text in rows:
        words = (text or "").split()
        runs = brute(words)
        assert [(r.start, r.period, r.length) for r in got[k].runs] == runs and got[k].n == len(words)
        assert got[k].collapsed == (" ".join(collapsed(words, runs)).encode() if runs else None)


def test_empty_table(spark):
    assert periodic_runs(spark.createDataFrame([], "doc_id string, text string")).collect() == []
