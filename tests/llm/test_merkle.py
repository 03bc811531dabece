"""Manifest and proofs against a plain list version."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from weft.llm import merkle


def digest(*parts: bytes) -> bytes:
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def field(value) -> bytes:
    if value is None:
        return b"-"
    raw = str(value).encode()
    return b"%d:%s" % (len(raw), raw)


def tree(nodes):
    """Root and, for each node, its siblings (before, after) level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, k in zip(paths, range(len(paths)), strict=True):
            run = nodes[at[k] // 3 * 3:at[k] // 3 * 3 + 3]
            path.append((b"".join(run[:at[k] % 3]), b"".join(run[at[k] % 3 + 1:])))
            at[k] //= 3
        nodes = [digest(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def brute(rows, alter=lambda r: r):
    """Sorted (id, leaf, subroot, root, proof digest, folded root) of rows (doc_id, source, lang, n_chars, text)."""
    if not rows:
        return []
    leaf = lambda r: digest(*map(field, r))
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    for own in by.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([leaf(r) for r in by[s]]) for s in names}
    root, tops = tree([trees[s][0] for s in names])
    out = []
    for s, top in zip(names, tops, strict=True):
        for r, path in zip(by[s], trees[s][1], strict=True):
            node = leaf(alter(r))
            for before, after in path + top:
                node = digest(before, node, after)
            out.append((r[0], leaf(r).decode(), trees[s][0].decode(), root.decode(),
                        digest(*[x for level in path + top for x in level]).decode(), node.decode()))
    return sorted(out, key=str)


def less(r):
    even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
    return (*r[:4], r[4].replace("\n", "") if even and r[4] is not None else r[4])


SHAPE = "doc_id long, source string, lang string, n_chars long, text string"


def found(spark, tmp_path, rows, **extra):
    df = spark.createDataFrame(rows, SHAPE)
    for name, value in extra.items():
        df = df.withColumn(name, F.lit(value))
    df.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = merkle.op11_merkle_manifest(spark, str(tmp_path)).collect()
    assert all(r.verified == (r.folded_root == r.root) for r in got)
    return sorted([(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root) for r in got], key=str)


def test_against_lists_over_several_rounds(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merkle, "ROUND", 2)
    monkeypatch.setattr(merkle.climb, "__defaults__", (2,))
    monkeypatch.setattr(merkle.descend, "__defaults__", (2,))
    rows = [(k, "hot" if k % 3 else f"s{k % 7}", "en" if k % 2 else None, k, f"line {k}\nand\n" * (k % 4)) for k in range(130)]
    got = found(spark, tmp_path, rows)
    assert got == brute(rows, less) and len(got) == 130
    assert any(r[5] != r[3] for r in got) and any(r[5] == r[3] for r in got)


def test_odd_rows(spark, tmp_path):
    rows = [(7, None, None, None, None), (7, None, None, None, None), (7, None, "en", 1, "x\n"), (None, "", None, 0, ""),
            (1, "", "é", 3, "a\nb"), (2, "é", "-", 2, "2:xx" * 50_000), (3, "z", None, None, "ü\n"), (None, "z", None, None, None)]
    assert found(spark, tmp_path, rows, key="k", i=1, n=2, q1=3, block=4, digest="d", proof="p") == brute(rows, less)


def test_one_row_and_none(spark, tmp_path):
    one = [(5, "a", "en", 1, "t")]
    (got,) = found(spark, tmp_path, one)
    assert [got] == brute(one, less) and got[1] == got[2] == got[3] and got[4] == hashlib.sha256(b"").hexdigest()
    (tmp_path / "none").mkdir()
    assert found(spark, tmp_path / "none", []) == []


def test_a_proof_fails_for_another_leaf(spark):
    df = spark.createDataFrame([(k, "a" if k < 20 else "b", f"t{k}") for k in range(30)], "id long, of string, text string")
    made = merkle.dataset_manifest(df, "id", "of", ["id", "text"])
    other = made.select("root", "proof", merkle.fold(F.col("leaf"), F.col("proof")).alias("good"),
                        merkle.fold(merkle.leaf_digest([F.lit("x")]), F.col("proof")).alias("bad")).collect()
    assert all(r.good == r.root != r.bad for r in other) and len({r.root for r in other}) == 1


@pytest.mark.parametrize("n", [3, 4, 10])
def test_groups_as_many_as_rows(spark, tmp_path, n):
    rows = [(k, f"s{k:02d}", None, k, "t") for k in range(n)]
    assert found(spark, tmp_path, rows) == brute(rows, less)
