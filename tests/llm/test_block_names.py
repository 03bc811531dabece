"""Exact duplicates against grouping by text."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from weft.llm.block_names import exact_duplicates, identify, name_equal


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        kept = False
        for i in ids:
            out.append((i, keep, len(ids), i == keep and not kept, sha))
            kept |= i == keep
    return sorted(out, key=str)


def check(spark, rows, **how):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("name", F.lit("x")).withColumn("row", F.lit(1)).withColumn("id", F.lit(0))
    got = exact_duplicates(df.repartition(5), **how).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_small_blocks_and_hot_groups(spark):
    rng = random.Random(1)
    rows = [(k, "".join(rng.choice("ab") for _ in range(rng.randint(0, 40)))) for k in range(300)]
    rows += [(1000 + k, "the hot text of many copies" * 3) for k in range(200)]
    rows += [(2000 + k, "the hot text of many copies" * 3 + "!") for k in range(5)]
    check(spark, rows, block=4, split=20)


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_texts_that_share_all_but_one_block(spark, block):
    long = "abcdefghij" * 40
    rows = [(k, long[:k] + "#" + long[k + 1:]) for k in range(0, 400, 37)] + [(500, long), (501, long), (502, long[:-1]), (503, long + "\0"), (504, long[::-1])]
    check(spark, rows, block=block, split=3)


def test_odd_rows(spark):
    check(spark, [(1, None), (2, ""), (2, ""), (None, ""), (None, "only"), (None, "only"), (9, "é"), (9, "é"), (3, "é"), (4, "x" * 300_000), (5, "x" * 300_000), (6, "x" * 300_001)])
    check(spark, [(None, None)])
    assert exact_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_names_stand_for_contents(spark):
    rows = [(k, bytes([k % 50])) for k in range(1000)]
    named = name_equal(spark.createDataFrame(rows, "k long, content binary").repartition(7), "content", ["k"], 1000, split=5).collect()
    by = {}
    for r in named:
        by.setdefault(r.name, set()).add(r.k % 50)
    assert len(named) == 1000 and len(by) == 50 and all(len(v) == 1 for v in by.values())


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a b" * 5000), (2, "c")], "doc_id long, text string")
    rows, n = identify(df)
    plan = rows._jdf.queryExecution().toString() + exact_duplicates(df)._jdf.queryExecution().toString()
    assert n == 2 and "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
