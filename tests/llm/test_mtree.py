"""Exact top-k against brute force."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from weft.llm import mtree


def brute(rows, k, every):
    fine = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            fine.append((i, [math.floor(64 * x) for x in v]))
    out = []
    for q, a in {(q, tuple(a)) for q, a in fine if q % every == 0}:
        hits = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in fine if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(hits)]
    return sorted(out)


def _run(spark, rows, k=20, every=5):
    df = spark.createDataFrame([(i, v, 3, 1) for i, v in rows], "vec_id long, embedding array<float>, score int, rank int").repartition(4)
    return sorted(tuple(r) for r in mtree.top_k(df, F.col("vec_id") % every == 0, k).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_top_k_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(mtree, "PIVOT_ROWS", 60)
    monkeypatch.setattr(mtree, "TREE_ROWS", 50)
    monkeypatch.setattr(mtree, "QUERY_ROWS", 30)
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (6, 8))
    rows = [(i, (centres[i % 6] + rng.normal(0, 0.2, 8)).astype(np.float32).tolist()) for i in range(500)]
    rows += [(500 + i, rows[3][1]) for i in range(40)]  # a common vector, ties beyond k
    rows += [(600, None), (605, [float("nan")] * 8), (610, [None] * 8), (615, [float("inf")] + [0.0] * 7), (620, []), (625, [0.5] * 3), (None, [0.1] * 8)]
    rows += [(700 + i, [0.0] * 8) for i in range(30)]
    assert _run(spark, rows) == brute(rows, 20, 5)


def test_few_rows_and_empty_table(spark):
    rows = [(0, [0.5, 0.25]), (1, [1.0, -1.0]), (2, [0.5, 0.25])]
    assert _run(spark, rows) == brute(rows, 20, 5) == [(0, 1, 2, 32 * 32 + 16 * 16), (0, 2, 1, 32 * 64 - 16 * 64)]
    assert _run(spark, rows[:1]) == []
    assert _run(spark, [(1, [1.0])]) == []
    assert mtree.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).count() == 0


def test_repeated_ids_equal_the_sql(spark, monkeypatch):
    monkeypatch.setattr(mtree, "PIVOT_ROWS", 20)
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 1, 4).astype(np.float32).tolist()) for i in range(150)]
    rows += [rows[0]] * 2 + [rows[20]] * 24 + [rows[7]] * 2 + [rows[8]] * 30  # copies of queries and of candidates
    rows += [(40, rng.normal(0, 3, 4).astype(np.float32).tolist()) for _ in range(25)]  # one id, many vectors
    rows += [(60, rows[0][1]), (61, rows[0][1]), (60, rows[20][1])]
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    want = sorted(con.execute(mtree.OP8_SQL).fetchall())
    assert {q for q, *_ in want} == set(range(0, 150, 20)) and len(want) == 8 * 20
    assert _run(spark, rows, every=20) == want


def test_three_copies_of_a_query_keep_k_rows(spark):
    rows = [(i, [float(i % 17), 1.0]) for i in range(1, 60)]
    once = [(0, [9.0, 0.5]), *rows]
    assert [r[1:] for r in _run(spark, once * 3, k=20, every=100)] == [
        (n + 1, i, s) for n, (i, s) in enumerate([(i, s) for _, _, i, s in brute(once, 20, 100) for _ in range(9)][:20])]


def test_tree_bounds_hold_and_search_skips_pages():
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 30, (20, 6))
    points = np.floor(np.repeat(centres, 100, axis=0) + rng.normal(0, 1, (2000, 6)))
    tree = mtree.MTree(points)
    assert sorted(np.concatenate([e for level, e, _ in tree.pages if level == 0]).tolist()) == list(range(2000))
    assert max(len(e) for _, e, _ in tree.pages) <= mtree.PAGE
    looked = []

    def nearest(q):
        def score(rows):
            looked.append(len(rows))
            return -((points[rows] - q) ** 2).sum(axis=1)
        rows, scores = tree.search(q, score, 10, -math.inf, lambda s: math.inf if s == -math.inf else math.sqrt(-s) + 1e-9)
        return sorted(scores.tolist(), reverse=True)[:10]

    for q in points[::100]:
        assert nearest(q) == sorted((-((points - q) ** 2).sum(axis=1)).tolist(), reverse=True)[:10]
    assert sum(looked) < 20 * 2000 * 0.5


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_many_queries_at_once_equal_one_by_one(seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 30, (20, 6))
    points = np.floor(np.repeat(centres, 100, axis=0) + rng.normal(0, 1, (2000, 6)))
    points[50:80] = points[3]
    tree = mtree.MTree(points)
    queries = np.concatenate([points[::40], np.floor(rng.normal(0, 40, (20, 6)))])
    need = rng.integers(1, 30, len(queries))
    looked = []

    def score(rows, numbers):
        looked.append(len(rows) * len(numbers))
        return -((points[rows][None] - queries[numbers][:, None]) ** 2).sum(axis=2)

    def distance_of(scores, numbers):
        return np.where(np.isneginf(scores), np.inf, np.sqrt(np.maximum(-scores, 0)) + 1e-9)

    everything = -((points[None] - queries[:, None]) ** 2).sum(axis=2)
    known = np.where(rng.random(len(queries)) < 0.5, -np.inf, np.sort(everything, axis=1)[np.arange(len(queries)), -need])  # a bound that holds
    number, rows, scores = tree.search_many(queries, score, need, known, distance_of)
    for q in range(len(queries)):
        own = number == q
        assert len(set(rows[own].tolist())) == own.sum() and (scores[own] == everything[q, rows[own]]).all()
        worst = np.sort(everything[q])[-need[q]]
        assert set(rows[own].tolist()) == set(np.flatnonzero(everything[q] >= worst).tolist())
    assert sum(looked) < 0.5 * everything.size
