"""The pipeline's rows against stage-by-stage brute force, and odd documents through every stage."""

from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from test_simhash_and_decontam import brute_classes, brute_fingerprint, brute_leaks
from weft.llm import bpe, langid, rules
from weft.llm.common import table

SF = "/root/testdata/sf0.001"


def test_pipeline_equals_brute_force(spark):
    docs = table(spark, SF, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    model = rules.learn(docs, table(spark, SF, "labels"), ~rules.fifth_held_out())
    scored = {r.doc_id: r.s for r in rules.with_statistics(docs, keep=["doc_id"]).select("doc_id", model.score().alias("s")).collect()}
    kept = [i for i in sorted(rows) if scored[i] >= rules.THRESHOLD]
    assert 0 < len(kept) < len(rows)
    good = docs.where(docs.doc_id.isin(kept))
    net = langid.train(*langid.sample(good, ~langid.third_held_out()))
    langs = dict(zip(kept, zip(*langid.classify(net, [rows[i].text.encode() for i in kept])), strict=True))
    held, names = langid.sample(good, langid.third_held_out())
    right = sorted(s for x, s, y in zip(*langid.classify(net, held), names, strict=True) if x == y)
    least = min(0.5, right[int(0.001 * (len(right) - 1))])
    kept = [i for i in kept if langs[i][0] != "und" and langs[i][1] >= least]
    classes = brute_classes([brute_fingerprint(rows[i].text) for i in kept])
    kept = [i for k, i in enumerate(kept) if classes[k] == k]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    leaked = {d for d, _ in brute_leaks([(i, rows[i].text) for i in kept], items)}
    kept = [i for i in kept if i not in leaked]
    codec = bpe.public_codec()
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    want = {}
    for i in kept:
        ids = coder.encode_ordinary(rows[i].text)
        want[i] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(rows[i].text.encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want


@pytest.mark.parametrize("empty", [False, True])
def test_odd_documents_through_every_stage(spark, empty):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "The same words are here and there again.", "en", "s", 1),
            (3, "The same words are here and there again.", "en", "s", 1), (None, "No id but the words are fine.", "en", None, 2), (4, "and the of in to a " * 30_000, "en", "s", 3)]
    docs = spark.createDataFrame([(*r, 1.0, "x", 5) for r in ([] if empty else rows)],
                                 "doc_id long, text string, lang string, source string, n_chars long, score double, fp string, words int")
    docs = docs.withColumn("__own", F.lit("own")).withColumn("__id", F.lit(7)).withColumn("a.b", F.lit("dot")).withColumn("c0", F.lit(1.5)).withColumn("__text", F.lit("t"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "tokens":
            assert all(tuple(r[-5:]) == ("own", 7, "dot", 1.5, "t") for r in out.collect())
        assert name == "tokens" or out.columns == docs.columns
        assert name == "tokens" or out.dtypes == docs.dtypes
        out.collect()
        if empty:
            assert out.count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "duplicates", "leaks", "tokens"]
