"""SimHash classes and benchmark decontamination against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from weft.llm import decontam, simhash_golay as sg
from weft.llm.components import components

WORDS = [f"w{k}" for k in range(400)]


def brute_fingerprint(text: str | None) -> int:
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def brute_classes(prints: list[int], max_bits: int = 4) -> list[int]:
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= max_bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_fingerprints():
    rnd = random.Random(4)
    texts = [None, "", " \t\n", "One", "two Words", "a b c", "a b c d", "A  b\tc d\x0be", "Ünï CÖDE É x y z", "\x1c \x85 q"]
    texts += [" ".join(rnd.choice(WORDS) for _ in range(rnd.randint(1, 300))) for _ in range(30)] + ["long " * 50_000]
    for t in texts:
        assert sg.fingerprint(None if t is None else t.encode()) == brute_fingerprint(t)


def test_golay_sets_and_keys_are_complete():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 1 << 23, 3000)
    near = sg.near_codewords(words)
    assert set(np.unique((near >= 0).sum(axis=1))) == {1, 6}
    flipped = words ^ (1 << rng.integers(0, 23, 3000)) ^ (1 << rng.integers(0, 23, 3000))  # two bits or none
    for a, b in zip(near, sg.near_codewords(flipped), strict=True):
        assert {*a[a >= 0]} & {*b[b >= 0]}
    a = rng.integers(0, 2 ** 64, 6000, dtype=np.uint64)
    b = a.copy()
    for i in range(len(b)):
        for k in rng.choice(64, rng.integers(0, 5), replace=False):
            b[i] ^= np.uint64(1 << int(k))
    (ra, ka), (rb, kb) = sg.keys_of(a), sg.keys_of(b)
    both = set(zip(ra.tolist(), ka.tolist())) & set(zip(rb.tolist(), kb.tolist()))
    assert {r for r, _ in both} == set(range(len(a)))


@pytest.mark.parametrize("chunk", [sg.CHUNK, 3])
def test_links_connect_what_brute_force_connects(spark, chunk):
    rng = np.random.default_rng(chunk)
    centres = rng.integers(0, 2 ** 64, 12, dtype=np.uint64)
    prints = {0, 2 ** 64 - 1}
    for c in centres.tolist():  # chains and balls around a few centres
        at = c
        for _ in range(60):
            at ^= sum(1 << int(k) for k in rng.choice(64, int(rng.integers(1, 6)), replace=False))
            prints.add(at)
            if rng.random() < 0.7:
                at = c
    prints = sorted(prints)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    root = {r.node: r.root for r in components(sg.links(df, 4, chunk)).collect()}
    want = brute_classes(prints)
    got = [root.get(x, x) for x in signed]
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(1000, 1400)] + [(7, 3), (5, 5), (3, 7), (-9, 1399)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 161)} == {100}
    assert {got[i] for i in [7, 3, -9, *range(1000, 1400)]} == {-9} and 5 not in got
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _documents(spark):
    rnd = random.Random(8)
    base = " ".join(rnd.choice(WORDS) for _ in range(600))
    near = [" ".join([*base.split()[:300], "other", *base.split()[301 + k:]]) for k in (0, 1)]
    rows = [(4, base), (9, base), (2, base.upper()), (7, near[0]), (8, near[1]), (1, None), (3, ""), (5, "solo text here now"), (5, "solo text here now"),
            (6, "something else entirely " * 30), (None, "no id but words"), (None, base), (10, "x y z " * 60_000)]
    return spark.createDataFrame([(i, t, 1, "f") for i, t in rows], "doc_id long, text string, component_id int, fp string").repartition(3)


def test_near_duplicates_on_odd_rows(spark):
    docs = _documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    prints = [brute_fingerprint(t) for _, t in rows]
    root = brute_classes(prints)
    least = {c: min((rows[k][0] for k in range(len(rows)) if root[k] == c and rows[k][0] is not None), default=None) for c in set(root)}
    want = sorted(((i, format(p, "016x"), least[c]) for (i, _), p, c in zip(rows, prints, root, strict=True)), key=str)
    got = sorted((tuple(r) for r in sg.near_duplicates(docs).collect()), key=str)
    assert got == want
    assert sg.near_duplicates(docs.where("false")).count() == 0


def test_one_document_of_each_class_stays(spark):
    docs = _documents(spark)
    kept = sg.one_of_each(docs)
    assert kept.columns == docs.columns
    classes = {(r.doc_id, r.fingerprint): r.component_id for r in sg.near_duplicates(docs).collect()}
    n = len({(c, f) if c is None else c for (_, f), c in classes.items()})
    rows = kept.collect()
    assert len(rows) == n
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted({c for c in classes.values() if c is not None})
    assert [r.text for r in rows if r.doc_id is None] == ["no id but words"]
    assert sg.one_of_each(docs.where("false")).count() == 0


# ---------------------------------------------------------------- decontamination

def brute_leaks(docs, items):
    """Every item-sized window, clipped ones included, by its exact similarity."""
    out = set()
    for d, text in docs:
        words = decontam.words_of((text or "").lower())
        shingles = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        for k, item in items:
            own = decontam.words_of((item or "").lower())
            mine = Counter(tuple(own[i:i + 5]) for i in range(len(own) - 4))
            m = mine.total()
            if m and any(decontam.weighted_jaccard(Counter(shingles[max(a, 0):a + m]), mine) >= 0.8 for a in range(-m + 1, len(shingles))):
                out.add((d, k))
    return out


def _leak_cases():
    rnd = random.Random(2)
    say = lambda n: " ".join(rnd.choice(WORDS) for _ in range(n))
    items = [(k, say(rnd.randint(12, 70))) for k in range(25)] + [(30, "too short item"), (31, None), (32, "rep rep rep rep rep rep rep rep"), (33, "five words in this one")]
    docs = [(0, None), (1, ""), (2, say(300)), (None, "intro " + items[3][1])]
    for k in range(25):
        words = items[k][1].split()
        edit = list(words)
        edit[len(edit) // 2] = "changed"
        docs += [(100 + k, f"{say(40)} {items[k][1].upper().replace(' ', ', ')}! {say(30)}"),  # case and punctuation
                 (200 + k, f"{say(20)} {' '.join(edit)} {say(20)}"), (300 + k, " ".join(words[: int(len(words) * 0.9)])),
                 (400 + k, " ".join(words[len(words) // 2:]) + " " + say(20)), (500 + k, say(9) + " " + " ".join(words[:5]) + " " + say(9))]
    docs += [(600, "rep " * 500), (601, "x five words in this one y"), (602, say(20_000) + " " + items[7][1]), (603, items[0][1] + " " + items[1][1]), (603, items[0][1] + " " + items[1][1])]
    return docs, items


def test_leaks_equal_brute_force(spark):
    docs, items = _leak_cases()
    df = spark.createDataFrame([(i, t, 0.5) for i, t in docs], "doc_id long, text string, similarity double").repartition(4)
    bench = spark.createDataFrame([(k, t, "x") for k, t in items], "item_id long, text string, doc_id string")
    found = decontam.find_leaks(df, bench).collect()
    want = brute_leaks(docs, items)
    assert {(r.doc_id, r.item_id) for r in found} == want and len(want) > 60
    assert sum(r.doc_id == 603 for r in found) == 4  # each of the repeated rows
    texts = dict(docs)
    for r in found:
        if r.similarity == 1.0 and r.doc_id is not None:
            words = decontam.words_of(texts[r.doc_id].lower())[r.first_word:r.first_word + r.n_words]
            assert words == decontam.words_of(dict(items)[r.item_id].lower()) and r.distance == 0
    clean = decontam.drop_leaks(df, bench)
    leaked = {d for d, _ in want}
    assert clean.columns == df.columns
    assert sorted(map(str, (r.doc_id for r in clean.collect()))) == sorted(str(d) for d, _ in docs if d not in leaked)


def test_leaks_with_items_in_blocks_and_empty_tables(spark, monkeypatch):
    docs, items = _leak_cases()
    df = spark.createDataFrame(docs[:40], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = {(r.doc_id, r.item_id) for r in decontam.find_leaks(df, bench).collect()}
    monkeypatch.setattr(decontam.item_blocks, "__defaults__", ("item_id", "text", 300))
    assert len(list(decontam.item_blocks(bench))) > 2
    assert {(r.doc_id, r.item_id) for r in decontam.find_leaks(df, bench).collect()} == whole
    assert decontam.find_leaks(df.where("false"), bench).count() == 0
    assert decontam.find_leaks(df, bench.where("false")).count() == 0
    assert decontam.drop_leaks(df, bench.where("false")).count() == df.count()


@pytest.mark.parametrize("n", [200, 400])
@pytest.mark.parametrize("around", ["distinct", "repeated"])
def test_long_items_cut_inside_unknown_words_are_found(n, around):
    rnd = random.Random(n)
    items = [(k, " ".join(rnd.choice(WORDS) for _ in range(n))) for k in range(20)]
    index = decontam.ItemIndex(items)
    rest = [f"fremd{k}" if around == "distinct" else "fremd" for k in range(2 * n)]
    for k, text in items:
        doc = " ".join([*rest[:n], *text.split()[: int(n * 0.9) + 1], *rest[n:]])
        ((found, similarity, *_),) = index.matches(doc)
        assert found == k and 0.8 <= similarity < 0.9
    assert brute_leaks([(0, doc)], items[-1:]) == {(0, k)}


def test_short_items_and_unspaced_scripts_are_found():
    items = [(1, "Paris, Texas"), (2, "one"), (3, "four words are here"), (4, "春眠不觉晓,处处闻啼鸟"), (5, "สวัสดีชาวโลก"), (6, "日本"), (7, "..."), (8, "Paris Texas")]
    index = decontam.ItemIndex(items)
    found = lambda text: sorted((k, s, n) for k, s, _, _, n in index.matches(text))
    assert found("Road to PARIS -- Texas and Paris Texas") == [(1, 1.0, 2), (8, 1.0, 2)]
    assert found("One") == [(2, 1.0, 1)] and found("someone, onerous; Texas Paris") == [] == found("four words are") == found("")
    assert found("so four words are here too") == [(3, 1.0, 4)]
    assert found("前言春眠不觉晓处处闻啼鸟后记") == [(4, 1.0, 10)]
    assert [k for k, *_ in found("กขคงสวัสดีชาวโลกกขคง")] == [5]
    assert found("东日本大") == [(6, 1.0, 2)] and found("日 x 本") == []
    assert decontam.words_of("Ünï_1 çö 漢字kana ab") == ["Ünï_1", "çö", "漢", "字", "kana", "ab"]


def test_multi_index_finds_every_item_within_the_radius():
    index = decontam.ItemIndex(_leak_cases()[1])
    rng = np.random.default_rng(6)
    for k, value in enumerate(index.prints):
        length = sum(index.counts[k].values())
        for _ in range(40):
            other = value ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, decontam.RADIUS + 1)), replace=False))
            assert k in index.candidates(length, other)
