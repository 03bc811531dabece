"""Quality classification with a sparse ensemble of rules.

1. Each whole text becomes a row of statistics (byte classes, words, lines).
2. Shallow trees are boosted on labelled rows; every path from a root to a node is a
   rule: a conjunction of thresholds on statistics.
3. A logistic model with an L1 penalty over the rules keeps few of them.
4. The kept rules are compiled to Spark column expressions over the statistics, and the
   score is the logistic of their weighted sum.

The fit runs in numpy on the driver, on at most ``SAMPLE_ROWS`` labelled rows (the first by
a hash of the id; some 20 numbers each). Scoring never reads labels, language, source or
id. Null texts are scored as empty ones. A row without a quality label (null) teaches
nothing, repeated label rows each count. Without any labelled row, or with one class only,
the score is the share of label 1 (0.5 if there is none). An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm.common import by_place, table

SAMPLE_ROWS = 20_000
TREES = 24
DEPTH = 3
SHRINKAGE = 0.3
CUTS = 32  # thresholds tried for a statistic
LEAST_LEAF = 10
PENALTY = 0.002
THRESHOLD = 0.3

SYMBOLS = b"#$%&*+<=>@[\\]^_`{|}~"
STATISTICS = ["bytes", "words", "lines", "upper", "symbols", "marks", "pipes", "digits", "punctuation", "non_ascii",
              "word_length", "new_words", "new_lines", "top_word", "line_words", "ends", "longest_word", "spaces"]

# Their columns; names that begin with two underscores are kept for these.
COLUMNS = [f"__{name}" for name in STATISTICS]


def statistics(text: bytes | None) -> list[float]:
    """The numbers of ``STATISTICS`` for a text."""
    text = text or b""
    words, lines = text.split(), [x for x in text.split(b"\n") if x.strip()]
    n, n_words, n_lines = max(len(text), 1), max(len(words), 1), max(len(lines), 1)
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    among = lambda chars: float(count[np.frombuffer(chars, np.uint8)].sum())
    upper, lower = float(count[65:91].sum()), float(count[97:123].sum())
    kinds: dict[bytes, int] = {}
    for w in words:
        kinds[w] = kinds.get(w, 0) + 1
    return [float(len(text)), float(len(words)), float(len(lines)), upper / max(upper + lower, 1.0), among(SYMBOLS) / n,
            float(count[33]) / n_words, float(count[124]) / n_words, float(count[48:58].sum()) / n, among(b".,;:?'\"()-") / n,
            float(count[128:].sum()) / n, (n - float(count[9:14].sum()) - float(count[32])) / n_words, len(kinds) / n_words,
            len({*lines}) / n_lines, max(kinds.values(), default=0) / n_words, n_words / n_lines,
            sum(x.rstrip()[-1:] in b".!?" for x in lines) / n_lines, float(max(map(len, words), default=0)), float(count[32]) / n]


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, is-above, threshold), and its weight."""

    terms: tuple[tuple[int, bool, float], ...]
    weight: float = 0.0

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for k, above, cut in self.terms:
            out &= (x[:, k] > cut) if above else (x[:, k] <= cut)
        return out

    def column(self) -> Column:
        out = None
        for k, above, cut in self.terms:
            term = F.col(COLUMNS[k]) > cut if above else F.col(COLUMNS[k]) <= cut
            out = term if out is None else out & term
        return out


@dataclass(frozen=True)
class Ensemble:
    rules: tuple[Rule, ...]
    intercept: float

    def score(self) -> Column:
        """The probability of label 1, as an expression over ``COLUMNS``."""
        total = F.lit(self.intercept)
        for rule in self.rules:
            total = total + F.when(rule.column(), F.lit(rule.weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _grow(x: np.ndarray, gradient: np.ndarray, weight: np.ndarray, cuts: list[np.ndarray], rows: np.ndarray,
          terms: tuple, depth: int, paths: list, value: np.ndarray) -> None:
    """One tree on a second-order step; fills ``value`` and collects the paths of its nodes."""
    g, h = gradient[rows].sum(), weight[rows].sum()
    value[rows] = g / (h + 1.0)
    if terms:
        paths.append(terms)
    if not depth:
        return
    best = (1e-6, None, None)
    for k, edges in enumerate(cuts):
        if not len(edges):
            continue
        place = np.searchsorted(edges, x[rows, k])  # place <= i: at most edges[i]
        size = len(edges) + 1
        gs = np.cumsum(np.bincount(place, gradient[rows], size))[:-1]
        hs = np.cumsum(np.bincount(place, weight[rows], size))[:-1]
        ns = np.cumsum(np.bincount(place, minlength=size))[:-1]
        gain = gs ** 2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g ** 2 / (h + 1)
        gain[(ns < LEAST_LEAF) | (len(rows) - ns < LEAST_LEAF)] = 0
        i = int(gain.argmax())
        if gain[i] > best[0]:
            best = (float(gain[i]), k, float(edges[i]))
    if best[1] is None:
        return
    _, k, cut = best
    low = x[rows, k] <= cut
    _grow(x, gradient, weight, cuts, rows[low], (*terms, (k, False, cut)), depth - 1, paths, value)
    _grow(x, gradient, weight, cuts, rows[~low], (*terms, (k, True, cut)), depth - 1, paths, value)


def _paths(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """Rules of boosted trees."""
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, CUTS + 2)[1:-1])) for k in range(x.shape[1])]
    cuts = [(c[1:] + c[:-1]) / 2 if len(c) > 1 else c for c in cuts]
    margin = np.full(len(y), math.log(y.mean() / (1 - y.mean())))
    rng, paths = np.random.default_rng(11), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        value = np.zeros(len(y))
        some = np.flatnonzero(rng.random(len(y)) < 0.7)
        _grow(x, y - p, np.maximum(p * (1 - p), 1e-6), cuts, some, (), DEPTH, paths, value)
        step = np.zeros(len(y))
        step[some] = value[some]
        margin = margin + SHRINKAGE * step
    return [Rule(t) for t in dict.fromkeys(paths)]


def fit(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY) -> Ensemble:
    """Rules and their weights, by proximal gradient steps with momentum (intercept unpenalised)."""
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Ensemble((), math.log(share / (1 - share)))
    rules = _paths(x, y)
    held = np.stack([r.holds(x) for r in rules], axis=1).astype(np.float64) if rules else np.zeros((len(y), 0))
    mean = held.mean(axis=0)
    spread = np.maximum(held.std(axis=0), 0.05)
    z = np.concatenate([np.ones((len(y), 1)), (held - mean) / spread], axis=1)
    step = 4.0 * len(y) / np.linalg.norm(z, 2) ** 2
    w = np.zeros(z.shape[1])
    w[0] = math.log(y.mean() / (1 - y.mean()))
    ahead, t = w.copy(), 1.0
    for _ in range(400):
        new = ahead - step * (z.T @ (1 / (1 + np.exp(-(z @ ahead))) - y)) / len(y)
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        t_new = (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    weights = w[1:] / spread
    kept = tuple(Rule(r.terms, float(v)) for r, v in zip(rules, weights, strict=True) if v)
    return Ensemble(kept, float(w[0] - (weights * mean).sum()))


def with_statistics(docs: DataFrame, text_col: str = "text", keep: Iterable[str] = ()) -> DataFrame:
    """The columns of ``keep`` and ``COLUMNS`` for every row."""
    rows = docs.select(*keep, F.col(text_col).cast("binary").alias("__text"))

    def run(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            x = np.array([statistics(t.as_py()) for t in batch.column("__text")], np.float64).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(batch.schema) - 1)), *(pa.array(x[:, k]) for k in range(len(STATISTICS)))],
                [*batch.schema.names[:-1], *COLUMNS])

    schema = rows.drop("__text").schema
    for name in COLUMNS:
        schema = schema.add(name, "double")
    return rows.mapInArrow(run, schema)


def learn(docs: DataFrame, labels: DataFrame, train: Column, label_col: str = "quality", id_col: str = "doc_id",
          text_col: str = "text", rows: int = SAMPLE_ROWS) -> Ensemble:
    """Fit on the texts of at most ``rows`` labels; train is a condition on their doc_id.

    That bound also makes the labels fit to be sent to the documents (20,000 rows of two numbers)."""
    marks = (labels.select("doc_id", F.col(label_col).cast("int").alias("__y")).where(F.col("__y").isin(0, 1) & train)
             .orderBy(F.xxhash64("doc_id"), "doc_id", "__y").limit(rows))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(marks), "doc_id")
    found = (with_statistics(texts, keep=["doc_id", "__y"]).orderBy(F.xxhash64("doc_id"), "doc_id", "__y").limit(rows)
             .select("__y", *COLUMNS).collect())
    data = np.array([list(r) for r in found], np.float64).reshape(-1, 1 + len(STATISTICS))
    return fit(data[:, 1:], data[:, 0])


def fifth_held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def score_quality(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    held = F.coalesce(held_out if held_out is not None else fifth_held_out(), F.lit(False))
    model = learn(docs, labels, ~held, id_col=id_col, text_col=text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return (with_statistics(rows, keep=["doc_id"]).select("doc_id", held.alias("held_out"), model.score().alias("score"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def keep_good(docs: DataFrame, labels: DataFrame, least: float = THRESHOLD) -> DataFrame:
    """The documents that score at least ``least``, with all their columns."""
    model = learn(docs, labels, ~F.coalesce(fifth_held_out(), F.lit(False)))
    rows, (text,) = by_place(docs, "text")
    kept = with_statistics(rows, text, keep=rows.columns).where(model.score() >= least)
    return kept.select(*rows.columns).toDF(*docs.columns)


def op9_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labels of those with crc32(doc_id) mod 5 not 0."""
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
