"""Language ID and quality rules: held-out accuracy, odd rows, gradients."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weft.llm import langid, rules
from weft.llm.common import table

SF = "/root/testdata/sf0.01"


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    model = langid.new_model(["a", "b", "c"])
    model.embedding, model.filters, model.dense = (x.astype(np.float64) for x in (model.embedding, model.filters, model.dense))
    model.bias, model.offset = model.bias.astype(np.float64), model.offset.astype(np.float64)
    windows, wanted = rng.integers(97, 110, (5, 20)).astype(np.uint8), np.array([0, 1, 2, 0, 1])

    def loss():
        return -np.log(langid.predict_windows(model, windows)[np.arange(5), wanted]).mean()

    for part, gradient in zip(model.parts(), langid._gradients(model, windows, wanted), strict=True):
        for _ in range(6):
            at = tuple(int(rng.integers(n)) for n in part.shape)
            if part is model.filters and not langid._mask()[at]:
                continue
            keep = part[at]
            part[at] = keep + 1e-5
            up = loss()
            part[at] = keep - 1e-5
            down = loss()
            part[at] = keep
            assert gradient[at] == pytest.approx((up - down) / 2e-5, abs=2e-4)


def test_windows_cover_the_whole_text():
    for n in (0, 1, 255, 256, 257, 5000):
        text = bytes(k % 250 + 1 for k in range(n))
        assert langid.as_windows(text).tobytes().rstrip(b"\0") == text


def test_language_accuracy_on_held_out_documents(spark):
    got = langid.op6_language_id(spark, SF)
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    docs = table(spark, SF, "documents")
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == docs.count() and sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(spark):
    model = langid.train([b"the cat and the dog of the house"] * 3 + ["le chat est dans la maison où".encode()] * 3, ["en"] * 3 + ["fr"] * 3, steps=60)
    rows = [(1, None), (2, ""), (3, "123 !!! \n"), (4, "the dog"), (4, "the dog"), (5, "le chat " * 100_000), (None, "é"), (6, "²½")]
    df = spark.createDataFrame([(i, t, "zz", 5.0) for i, t in rows], "doc_id long, text string, lang_pred string, score double")
    got = sorted(((r.doc_id, r.lang_pred, r.score) for r in langid.predict(df, model).collect()), key=str)
    und = {i for i, p, s in got if p == "und" and s == 0.0}
    assert und == {1, 2, 3, 6}
    assert [p for i, p, _ in got if i == 4] == ["en", "en"] and [p for i, p, _ in got if i == 5] == ["fr"]
    assert {r.lang_pred for r in langid.predict(df, None).collect()} == {"und"}
    assert langid.predict(df.where("false"), model).count() == 0
    unlabelled = df.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(unlabelled, F.lit(False)).collect()} == {"und"}
    empty = langid.keep_known(df.withColumn("lang", F.lit(None).cast("string")))
    assert empty.count() == 0 and empty.columns == [*df.columns, "lang"]


def plain_probabilities(model, text):
    """A text's probabilities by loops over its windows, positions and filters."""
    total, weight = np.zeros(len(model.labels)), 0
    for at in range(0, max(len(text), 1), langid.WINDOW):
        part = text[at:at + langid.WINDOW]
        vectors = [model.embedding[b].astype(np.float64) for b in part.ljust(langid.WINDOW, b"\0")]
        heard = []
        for f in range(model.filters.shape[1]):
            width = langid.WIDTHS[f // langid.FILTERS]
            taps = model.filters[:width * langid.EMBEDDING, f].astype(np.float64).reshape(width, langid.EMBEDDING)
            heard.append(max(sum(float(vectors[p + j] @ taps[j]) for j in range(width)) for p in range(langid.WINDOW - max(langid.WIDTHS) + 1)))
        logits = np.maximum(np.array(heard) + model.bias, 0) @ model.dense + model.offset
        chances = np.exp(logits - logits.max())
        total += len(part) * chances / chances.sum()
        weight += len(part)
    return total / weight


def test_whole_texts_equal_a_plain_forward_pass():
    model = langid.train([b"the cat and the dog of the house"] * 3 + ["le chat est dans la maison où".encode()] * 3, ["en"] * 3 + ["fr"] * 3, steps=40)
    texts = [b"a", b"the dog" * 100, "où est le chat ".encode() * 30 + b"the end of the house " * 20, b"x" * langid.WINDOW, b"y" * (langid.WINDOW + 1)]
    langs, scores = langid.classify(model, texts)
    for text, lang, score in zip(texts, langs, scores, strict=True):
        want = plain_probabilities(model, text)
        assert lang == model.labels[int(want.argmax())] and score == pytest.approx(want.max(), abs=1e-5)


def test_clear_texts_stay_and_the_model_decides(spark, monkeypatch):
    words = {"en": "the water runs under old bridges ", "ru": "вода течёт под старым мостом ", "el": "το νερό τρέχει κάτω από τη γέφυρα "}
    mixed = "".join((w * 40)[:len(w) * 12] for w in words.values())
    rows = [(k, words[lang] * 12, lang) for k, lang in enumerate([*words] * 40)] + [(900, mixed, None), (901, "12 - 34", None), (902, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in langid.keep_clear(docs).collect()}
    assert kept == set(range(120))  # three languages in equal parts are no clear text
    fitted = langid.train(*langid.sample(docs, ~langid.third_held_out()))
    assert langid.clear_score(fitted, [], []) == 0.0 and 0 < langid.clear_score(fitted, *langid.sample(docs, langid.third_held_out())) <= langid.CLEAR
    fitted.dense, fitted.offset = 0 * fitted.dense, 0 * fitted.offset  # a network that tells nothing
    monkeypatch.setattr(langid, "train", lambda *a: fitted)
    monkeypatch.setattr(langid, "clear_score", lambda *a: 0.5)
    assert langid.keep_clear(docs).collect() == []
    monkeypatch.setattr(langid, "train", lambda *a: None)
    assert langid.keep_clear(docs).collect() == []


def plain_statistics(text):
    """The 18 numbers of a text, each straight from its meaning."""
    data = (text or "").encode()
    words, lines = [w for w in re.split(rb"[ \t\n\v\f\r]+", data) if w], [x for x in data.split(b"\n") if x.strip(b" \t\n\v\f\r")]
    size, n, m = max(len(data), 1), max(len(words), 1), max(len(lines), 1)
    count = lambda allowed: sum(b in allowed for b in data)
    upper, lower = count(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), count(b"abcdefghijklmnopqrstuvwxyz")
    common = Counter(words).most_common(1)
    return {"bytes": len(data), "words": len(words), "lines": len(lines), "upper": upper / max(upper + lower, 1), "symbols": count(b"#$%&*+<=>@[\\]^_`{|}~") / size,
            "marks": data.count(b"!") / n, "pipes": data.count(b"|") / n, "digits": count(b"0123456789") / size, "punctuation": count(b".,;:?'\"()-") / size,
            "non_ascii": sum(b > 127 for b in data) / size, "word_length": (size - count(b" \t\n\v\f\r")) / n, "new_words": len(set(words)) / n,
            "new_lines": len(set(lines)) / m, "top_word": (common[0][1] if common else 0) / n, "line_words": n / m,
            "ends": sum(x.rstrip(b" \t\n\v\f\r")[-1:] in (b".", b"!", b"?") for x in lines) / m,
            "longest_word": max([len(w) for w in words], default=0), "spaces": data.count(b" ") / size}


@given(st.text(alphabet="aB9 \n\t!|.,#é漢", max_size=60))
@settings(max_examples=200, deadline=None)
def test_statistics_equal_a_plain_count(text):
    want = plain_statistics(text)
    assert rules.statistics(text.encode()) == pytest.approx([want[name] for name in rules.STATISTICS])


def test_scores_of_documents_equal_a_plain_evaluation(spark):
    docs, labels = table(spark, "/root/testdata/sf0.001", "documents"), table(spark, "/root/testdata/sf0.001", "labels")
    model = rules.learn(docs, labels, ~rules.fifth_held_out())
    want = {}
    for r in docs.collect():
        numbers = plain_statistics(r.text)
        x = [numbers[name] for name in rules.STATISTICS]
        total = model.intercept + sum(rule.weight for rule in model.rules if all((x[k] > cut) == above for k, above, cut in rule.terms))
        want[r.doc_id] = 1 / (1 + math.exp(-total))
    got = {r.doc_id: r.score for r in rules.op9_rule_quality(spark, "/root/testdata/sf0.001").collect()}
    assert got == pytest.approx(want)


def test_quality_on_held_out_documents(spark):
    got = rules.op9_rule_quality(spark, SF)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(table(spark, SF, "labels"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert got.count() == table(spark, SF, "documents").count()
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_rules_compile_to_the_same_scores(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (800, len(rules.STATISTICS)))
    y = ((x[:, 3] > 0.4) & (x[:, 5] < 0.9) | (rng.random(800) < 0.05)).astype(float)
    model = rules.fit(x, y)
    assert 0 < len(model.rules) < 120
    total = model.intercept + sum(r.weight * r.holds(x) for r in model.rules)
    want = 1 / (1 + np.exp(-total))
    df = spark.createDataFrame([(i, *map(float, row)) for i, row in enumerate(x)], "i int, " + ", ".join(f"{c} double" for c in rules.COLUMNS))
    got = np.array([r[0] for r in df.orderBy("i").select(model.score()).collect()])
    assert np.allclose(got, want) and ((want > 0.5) == (y > 0.5)).mean() > 0.93


def test_quality_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "Plain words in a line."), (3, "Plain words in a line."), (None, "no id"), (4, "LOUD!! " * 50_000), (5, "\n\n")]
    docs = spark.createDataFrame([(i, t, 1.0, 2.0) for i, t in rows], "doc_id long, text string, score double, words double")
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 0), (3, None, 0), (77, 1, 1)], "doc_id long, quality int, toxic int")
    got = rules.score_quality(docs, labels, F.lit(False))
    assert got.count() == len(rows) and all(0 <= r.score <= 1 for r in got.collect())
    for none in (labels.where("false"), labels.where("doc_id = 3")):  # nothing to learn, or one class
        assert got.count() == rules.score_quality(docs, none, F.lit(False)).count()
    assert {r.score for r in rules.score_quality(docs, labels.where("false"), F.lit(False)).collect()} == {0.5}
    assert rules.score_quality(docs.where("false"), labels).count() == 0
    kept = rules.keep_good(docs, labels.where("false"))
    assert kept.columns == docs.columns and kept.count() == len(rows)


def test_recognised_texts_stay_whatever_their_score(spark):
    words = {"en": "the water runs under old bridges ", "ru": "вода течёт под старым мостом ", "el": "το νερό τρέχει κάτω από τη γέφυρα "}
    mixed = "".join((w * 40)[:len(w) * 12] for w in words.values())
    rows = [(k, words[lang] * 12, lang) for k, lang in enumerate([*words] * 40)] + [(900, mixed, None), (901, "12 - 34", None), (902, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.doc_id for r in langid.keep_known(docs).collect()} == {i for i, _, _ in rows} - {901, 902}
    model = langid.train(*langid.sample(docs, ~langid.third_held_out()))
    (name,), (score,) = langid.classify(model, [mixed.encode()])
    assert name != "und" and score < 0.5


def test_clear_stage_learns_from_every_byte_of_every_row(spark, monkeypatch):
    words = {"en": "the water runs under old bridges ", "ru": "вода течёт под старым мостом "}
    rows = [(k, words[lang] * 100, lang) for k, lang in enumerate([*words] * 9)]
    learning = [r.k for r in spark.range(18).select(F.col("id").alias("k")).where(~langid.third_held_out("k")).orderBy("k").collect()]
    found = []
    monkeypatch.setattr(langid, "keep_known", lambda docs, least, model: found.append(model))

    def frame(parts, changed=None):
        told = [(k, "zebra quartz " + t[13:] if k == changed else t, lang) for k, t, lang in rows]
        return spark.createDataFrame(told, "doc_id long, text string, lang string").repartition(parts)

    plain = langid.sample(frame(1), ~langid.third_held_out())
    changed = next(k for k in learning if langid.sample(frame(1, k), ~langid.third_held_out()) == plain)  # in no excerpt
    for docs in (frame(1), frame(5), frame(1, changed)):
        langid.keep_clear(docs)
    one, five, other = ([p.tobytes() for p in model.parts()] for model in found)
    assert one == five and one != other


def test_clear_score_is_the_exact_place_among_all_texts(spark):
    rows = [(k, ("the water runs " if k % 2 else "вода течёт ") * (k % 40) + chr(97 + k % 26) * (k % 7), "en" if k % 2 else "ru") for k in range(1500)]
    docs = spark.createDataFrame([*rows, (1500, None, "en"), (1501, "", "ru"), (1502, "no language", None)], "doc_id long, text string, lang string")
    model = langid.new_model(["en", "ru", "zz"])
    for lost in (0.001, 0.3, 0.99):
        got = langid.clear_score(model, langid.labelled(docs, F.lit(True)), None, lost)
        assert got == pytest.approx(langid.clear_score(model, [t.encode() for _, t, _ in rows], [x for _, _, x in rows], lost), abs=1e-6)
    assert langid.clear_score(model, langid.labelled(docs, F.lit(False)), None) == 0.0
    values = [float(x) for x in np.random.default_rng(3).choice([0.1, 0.25, *np.random.default_rng(4).random(2000)], 4000)]
    scores = spark.createDataFrame([(x,) for x in values], "score double")
    assert [langid._smallest(scores, k) for k in (0, 7, 2222, 3999)] == [sorted(values)[k] for k in (0, 7, 2222, 3999)]
