"""Language identification with a byte-level convolutional network.

Network: byte embedding, filters of several widths over a window of ``WINDOW`` bytes,
rectifier, max pooling over the window, softmax. It is written and trained in numpy
(Adam, hand-derived gradients).

``keep_clear``, the stage of the pipeline, learns from every window of every labelled row:
the rows are dealt to groups by a hash, in each of ``PASSES`` passes a task takes the network
through the windows of a group, and the weights that come out, averaged by windows, begin the
next pass. The score it asks for is an exact order statistic of all held-out labelled texts.

``identify`` and ``keep_known`` learn on the driver, on a bounded sample of labelled rows: at
most ``SAMPLE_ROWS`` rows of each language, the first by a hash of the id, and of each an
excerpt of ``EXCERPT`` bytes from a place that the hash names.

Prediction covers whole texts: a text is cut to consecutive windows (the last is padded),
the network is applied to batches of windows of many texts, and a text's probabilities
are the mean of its windows', weighted by their bytes. The prediction reads the text only.

A text that is null, or has no letter, is ``und`` with score 0. If there is no labelled
row, so no language to learn, every text is ``und``. Equal probabilities go to the
language that sorts first. Repeated rows are predicted each; an empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weft.llm.common import by_place, materialise, raw_bytes, table

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8  # of each width
EMBEDDING = 6
SAMPLE_ROWS = 600
EXCERPT = 512
STEPS = 500
BATCH = 96
LEAST_BYTES = 6  # shortest excerpt that training shows
PASSES = 3       # over all labelled rows
WHOLE = 64       # windows of a step of these passes; a piece of half of them is shown too
CHUNK = 65_536   # windows that a task holds at once
UNIT = 1 << 20   # weights are summed as whole numbers of 1 / UNIT, in any order the same
BINS = 1024
WINDOWS_AT_ONCE = 256
UNKNOWN = "und"
LOST = 0.001  # share of held-out excerpts of known language that the filtering stage may lose
CLEAR = 0.5   # a text of at least this score is in one language


@dataclass
class ByteCNN:
    """Weights: embedding (256, EMBEDDING), filters (widest * EMBEDDING, all filters), dense."""

    labels: list[str]
    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    dense: np.ndarray
    offset: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.bias, self.dense, self.offset]


def _mask() -> np.ndarray:
    """Which filter weights exist: a filter of width w uses the first w bytes of the widest."""
    out = np.zeros((max(WIDTHS) * EMBEDDING, len(WIDTHS) * FILTERS), np.float32)
    for k, width in enumerate(WIDTHS):
        out[:width * EMBEDDING, k * FILTERS:(k + 1) * FILTERS] = 1
    return out


def new_model(labels: list[str], seed: int = 7) -> ByteCNN:
    rng = np.random.default_rng(seed)
    n = len(WIDTHS) * FILTERS
    scale = lambda *shape: rng.normal(0, 1, shape).astype(np.float32)
    return ByteCNN(labels, scale(256, EMBEDDING) * 0.5, scale(max(WIDTHS) * EMBEDDING, n) * 0.25 * _mask(),
                   np.zeros(n, np.float32), scale(n, len(labels)) * 0.2, np.zeros(len(labels), np.float32))


def _columns(model: ByteCNN, windows: np.ndarray) -> np.ndarray:
    """(windows, positions, widest * EMBEDDING): the embedded bytes that each position's filters see."""
    embedded = np.ascontiguousarray(model.embedding[windows])
    n, length, size = embedded.shape
    widest = max(WIDTHS)
    step = embedded.strides
    return np.lib.stride_tricks.as_strided(
        embedded, (n, length - widest + 1, widest * size), (step[0], step[1], step[2])).reshape(-1, widest * size)


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def predict_windows(model: ByteCNN, windows: np.ndarray) -> np.ndarray:
    """Probabilities of each label for windows (n, WINDOW) of bytes."""
    out = []
    for at in range(0, len(windows), WINDOWS_AT_ONCE):
        part = windows[at:at + WINDOWS_AT_ONCE]
        heard = (_columns(model, part) @ model.filters).reshape(len(part), -1, model.filters.shape[1]).max(axis=1)
        out.append(_softmax(np.maximum(heard + model.bias, 0) @ model.dense + model.offset))
    return np.concatenate(out) if out else np.zeros((0, len(model.labels)), np.float32)


def _gradients(model: ByteCNN, windows: np.ndarray, wanted: np.ndarray, share: np.ndarray | None = None) -> list[np.ndarray]:
    """Of the mean loss, or of the sum of the windows' losses times their ``share``."""
    columns = _columns(model, windows)
    n, f = len(windows), model.filters.shape[1]
    heard = (columns @ model.filters).reshape(n, -1, f)
    best = heard.argmax(axis=1)
    pooled = np.take_along_axis(heard, best[:, None, :], 1)[:, 0] + model.bias
    active = np.maximum(pooled, 0)
    error = _softmax(active @ model.dense + model.offset)
    error[np.arange(n), wanted] -= 1
    error = error / n if share is None else error * share[:, None]
    back = (error @ model.dense.T) * (pooled > 0)  # (n, f): reaches only the best position
    positions = heard.shape[1]
    seen = columns.reshape(n, positions, -1)[np.arange(n)[:, None], best]  # (n, f, k)
    d_filters = np.einsum("nfk,nf->kf", seen, back) * _mask()
    d_seen = back[:, :, None] * model.filters.T[None]  # (n, f, k)
    d_embedding = np.zeros_like(model.embedding)
    for j in range(max(WIDTHS)):
        bytes_ = windows[np.arange(n)[:, None], best + j]
        np.add.at(d_embedding, bytes_.ravel(), d_seen[:, :, j * EMBEDDING:(j + 1) * EMBEDDING].reshape(-1, EMBEDDING))
    return [d_embedding, d_filters, back.sum(axis=0), active.T @ error, error.sum(axis=0)]


def as_windows(text: bytes) -> np.ndarray:
    """Consecutive windows of a text, the last padded with zero bytes."""
    n = max(1, -(-len(text) // WINDOW))
    return np.frombuffer(text.ljust(n * WINDOW, b"\0"), np.uint8).reshape(n, WINDOW)


class _Adam:
    """Steps of a network along its gradients; the rate falls over the second half."""

    def __init__(self, model: ByteCNN):
        self.model, self.step = model, 0
        self.first = [np.zeros_like(p) for p in model.parts()]
        self.second = [np.zeros_like(p) for p in model.parts()]

    def take(self, gradients: list[np.ndarray], done: float) -> None:
        self.step += 1
        rate = 0.01 * min(1.0, 2 * (1 - done))
        for part, gradient, m, v in zip(self.model.parts(), gradients, self.first, self.second, strict=True):
            m += 0.1 * (gradient - m)
            v += 0.001 * (gradient ** 2 - v)
            part -= rate * (m / (1 - 0.9 ** self.step)) / (np.sqrt(v / (1 - 0.999 ** self.step)) + 1e-8)


def train(excerpts: list[bytes] | DataFrame, labels: list[str] | None, steps: int = STEPS, seed: int = 7) -> ByteCNN | None:
    """Fit on random windows of labelled excerpts, languages in equal shares; given rows of
    ``labelled`` instead, on every window of them all."""
    if isinstance(excerpts, DataFrame):
        return _train_on_all(excerpts, steps, seed)
    names = sorted({*labels})
    if not names:
        return None
    model, rng = new_model(names, seed), np.random.default_rng(seed)
    by = [[x for x, y in zip(excerpts, labels, strict=True) if y == name and x] or [b""] for name in names]
    adam = _Adam(model)
    for step in range(1, steps + 1):
        wanted = rng.integers(0, len(names), BATCH)
        windows = np.zeros((BATCH, WINDOW), np.uint8)
        for row, y in enumerate(wanted):
            text = by[y][rng.integers(len(by[y]))]
            size = min(len(text), int(rng.integers(LEAST_BYTES, WINDOW + 1)) if rng.random() < 0.5 else WINDOW)
            at = int(rng.integers(0, len(text) - size + 1))
            windows[row, :size] = np.frombuffer(text[at:at + size], np.uint8)
        adam.take(_gradients(model, windows, wanted), step / (steps + 1))
    return model


def labelled(docs: DataFrame, which: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, lang and text (binary) of all rows of ``which`` that have a language and a text."""
    text = F.col(text_col).cast("binary")
    return (docs.where(which & F.col(lang_col).isNotNull() & (F.octet_length(text) > 0))
            .select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), text.alias("text")))


def study(model: ByteCNN, windows: np.ndarray, sizes: np.ndarray, wanted: np.ndarray, times: int, turn: int, seed: int) -> None:
    """Take the network ``times`` through all windows (of ``sizes`` bytes of text) in pass ``turn``.
    In a step its languages have equal shares."""
    rng, adam = np.random.default_rng(seed), _Adam(model)
    starts = [(time, at) for time in range(times) for at in range(0, len(windows), WHOLE)]
    for k, (_, at) in enumerate(starts):
        if not at:
            order = rng.permutation(len(windows))
        rows = order[at:at + WHOLE]
        cut = rows[::2]
        pieces = np.zeros((len(cut), WINDOW), np.uint8)
        for i, row in enumerate(cut):
            size = int(rng.integers(min(LEAST_BYTES, sizes[row]), sizes[row] + 1))
            start = int(rng.integers(0, sizes[row] - size + 1))
            pieces[i, :size] = windows[row, start:start + size]
        shown, names = np.concatenate([windows[rows], pieces]), np.concatenate([wanted[rows], wanted[cut]])
        count = np.bincount(names)
        share = (1 / (np.count_nonzero(count) * count[names])).astype(np.float32)
        adam.take(_gradients(model, shown, names, share), (turn + k / len(starts)) / PASSES)


def _train_on_all(rows: DataFrame, steps: int, seed: int) -> ByteCNN | None:
    """Fit on every window of all rows of ``labelled``, in tasks of ``steps`` steps or more a pass.
    Groups and their order hang on the rows alone; few rows are one group, seen several times."""
    found = rows.groupBy("lang").agg(F.sum(F.ceil(F.octet_length("text") / WINDOW)).alias("n")).collect()
    names = sorted(r["lang"] for r in found)
    if not names:
        return None
    total = sum(r["n"] for r in found)
    groups, times = max(1, total // (steps * WHOLE)), -(-steps * WHOLE // (total * PASSES))
    spread = F.xxhash64("doc_id", "lang", "text")
    dealt = materialise(rows.select(F.pmod(spread, F.lit(groups)).cast("int").alias("group"), spread.alias("spread"), "lang", "text")
                        .repartitionByRange(groups, "group").sortWithinPartitions("group", "spread", "lang", "text")
                        .select("group", "lang", "text"), "language-rows")
    model = new_model(names, seed)
    for turn in range(PASSES):
        model = _one_pass(dealt, model, times, turn, seed)
    return model


def _one_pass(dealt: DataFrame, model: ByteCNN, times: int, turn: int, seed: int) -> ByteCNN:
    """The mean of the networks that have gone through one group each, by the windows of the group."""
    place_of = {name: k for k, name in enumerate(model.labels)}

    def run(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, parts, sizes, wanted, held = None, [], [], [], 0
        total = None

        def learned() -> np.ndarray:
            own = ByteCNN(model.labels, *(p.copy() for p in model.parts()))
            study(own, np.concatenate(parts), np.concatenate(sizes), np.repeat(wanted, [len(p) for p in parts]), times, turn, seed + group)
            weights = np.concatenate([p.ravel() for p in own.parts()] + [np.ones(1)]).astype(np.float64)  # the one counts windows
            weighed = np.rint(weights * UNIT).astype(np.int64) * held
            return weighed if total is None else total + weighed

        for batch in found:
            for g, lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                text = raw_bytes(text)
                for at in range(0, len(text), CHUNK * WINDOW):
                    part = text[at:at + CHUNK * WINDOW]
                    new = as_windows(part)
                    if parts and (g != group or held + len(new) > CHUNK):
                        total = learned()
                        parts, sizes, wanted, held = [], [], [], 0
                    group = g
                    parts.append(new)
                    sizes.append(np.minimum(len(part) - WINDOW * np.arange(len(new)), WINDOW))
                    wanted.append(place_of[lang])
                    held += len(new)
        if parts:
            total = learned()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["place", "weight"])

    sums = dealt.mapInArrow(run, "place int, weight long").groupBy("place").agg(F.sum("weight").alias("weight")).orderBy("place").collect()
    mean = np.array([r["weight"] for r in sums], np.float64) / sums[-1]["weight"]
    out, at = [], 0
    for part in model.parts():
        out.append(mean[at:at + part.size].reshape(part.shape).astype(np.float32))
        at += part.size
    return ByteCNN(model.labels, *out)


def sample(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           rows: int = SAMPLE_ROWS) -> tuple[list[bytes], list[str]]:
    """Excerpts and labels: at most ``rows`` of each language, of ``EXCERPT`` bytes each."""
    text = F.col(text_col).cast("binary")
    spread = F.xxhash64(F.col(id_col))
    start = F.pmod(spread, F.greatest(F.octet_length(text) - EXCERPT, F.lit(0)) + 1).cast("int") + 1
    labelled = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    # of large languages only the lowest hashes, about four times as many as are kept, meet in one place
    large = {r[0]: r[1] for r in labelled.groupBy(lang_col).count().where(F.col("count") > 4 * rows).collect()}
    if large:
        share = F.create_map(*(F.lit(x) for lang, n in sorted(large.items()) for x in (lang, 4.0 * rows / n)))
        low = F.pmod(spread, F.lit(1 << 30)) < F.coalesce(share[F.col(lang_col)], F.lit(1.0)) * (1 << 30)
        labelled = labelled.where(low)
    found = (labelled.select(F.col(lang_col).alias("lang"), spread.alias("spread"), F.substring(text, start, F.lit(EXCERPT)).alias("excerpt"))
             .withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("spread", F.lit(1 << 30)), "spread", "excerpt")))
             .where(F.col("place") <= rows).orderBy("lang", "place").collect())
    return [bytes(r["excerpt"]) for r in found], [r["lang"] for r in found]


def classify(model: ByteCNN | None, texts: Iterable[bytes | None]) -> tuple[list[str], list[float]]:
    """Language and score of each text."""
    import regex

    letter = regex.compile(r"\p{L}").search
    langs: list[str] = []
    scores: list[float] = []
    rows, parts, sizes, held = [], [], [], 0

    def flush() -> None:
        chances = predict_windows(model, np.concatenate(parts))
        at = 0
        for row, part, size in zip(rows, parts, sizes, strict=True):
            weight = np.full(len(part), WINDOW, np.float64)
            weight[-1] = size - WINDOW * (len(part) - 1)
            mean = (chances[at:at + len(part)] * weight[:, None]).sum(axis=0) / weight.sum()
            at += len(part)
            best = int(mean.argmax())
            langs[row], scores[row] = model.labels[best], min(1.0, float(mean[best]))

    for text in texts:
        langs.append(UNKNOWN)
        scores.append(0.0)
        if model is None or not text or not letter(text.decode("utf-8", "replace")):
            continue
        rows.append(len(langs) - 1)
        parts.append(as_windows(text))
        sizes.append(len(text))
        held += len(parts[-1])
        if held >= 4096:
            flush()
            rows, parts, sizes, held = [], [], [], 0
    if rows:
        flush()
    return langs, scores


def predict(docs: DataFrame, model: ByteCNN | None, id_col: str = "doc_id", text_col: str = "text",
            keep: Iterable[str] = ()) -> DataFrame:
    """doc_id, the columns of ``keep``, lang_pred and score of every text."""
    rows = docs.select(F.col(id_col).alias("doc_id"), *keep, F.col(text_col).cast("binary").alias("__text"))

    def run(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            langs, scores = classify(model, (t.as_py() for t in batch.column("__text")))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(batch.schema) - 1)), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                [*batch.schema.names[:-1], "lang_pred", "score"])

    schema = rows.drop("__text").schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(run, schema)


def keep_known(docs: DataFrame, least: float = 0.0, text_col: str = "text", model: ByteCNN | None = None) -> DataFrame:
    """The documents whose language is recognised (not ``und``), with all their columns; with
    ``least``, those of at least that score. Learned from ``docs`` where no model is given."""
    model = model or train(*sample(docs, ~F.coalesce(third_held_out(), F.lit(False))))
    place, names = docs.columns.index(text_col), docs.columns
    rows, _ = by_place(docs)

    def run(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            langs, scores = classify(model, map(raw_bytes, batch.column(place)))
            yield batch.filter(pa.array([x != UNKNOWN and s >= least for x, s in zip(langs, scores, strict=True)], pa.bool_()))

    return rows.mapInArrow(run, rows.schema).toDF(*names)


def _smallest(scores: DataFrame, place: int) -> float | None:
    """The value at ``place`` (from 0) of the sorted column ``score``, if it has so many: equal
    bins are counted, and the bin that holds the place is cut to bins again."""
    low, high = scores.agg(F.min("score"), F.max("score")).first()
    while low is not None and low < high:
        bins = F.least(F.floor((F.col("score") - low) / (high - low) * BINS), F.lit(BINS - 1))
        found = (scores.where(F.col("score").between(low, high)).groupBy(bins.alias("bin"))
                 .agg(F.count("*").alias("n"), F.min("score").alias("low"), F.max("score").alias("high")).orderBy("bin").collect())
        for r in found:
            if place < r["n"]:
                low, high = r["low"], r["high"]
                break
            place -= r["n"]
        else:
            return None
    return low


def clear_score(model: ByteCNN | None, excerpts: list[bytes] | DataFrame, labels: list[str] | None, lost: float = LOST) -> float:
    """The score that all but the share ``lost`` of the rightly predicted excerpts, or of all
    texts of ``labelled`` rows, reach, ``CLEAR`` at most."""
    if isinstance(excerpts, DataFrame):
        right = materialise(predict(excerpts, model, keep=["lang"]).where("lang_pred = lang").select("score"), "language-scores")
        n = right.count()
        return min(CLEAR, _smallest(right, int(lost * (n - 1)))) if n else 0.0
    langs, scores = classify(model, excerpts)
    right = [s for s, x, y in zip(scores, langs, labels, strict=True) if x == y]
    return min(CLEAR, float(np.quantile(right, lost, method="lower"))) if right else 0.0


def keep_clear(docs: DataFrame, lost: float = LOST) -> DataFrame:
    """The documents in one recognised language, with all their columns: those with a letter
    whose score reaches ``clear_score`` of all held-out labelled texts. Learned from all labelled
    documents that are not held out; without labels no language is known and all go."""
    held = F.coalesce(third_held_out(), F.lit(False))
    model = train(labelled(docs, ~held), None)
    if model is None:
        return docs.where(F.lit(False))
    return keep_known(docs, clear_score(model, labelled(docs, held), None, lost), model=model)


def identify(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the labelled rows that are not held out."""
    held = F.coalesce(held_out, F.lit(False))
    model = train(*sample(docs, ~held, id_col, text_col, lang_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), held.alias("held_out"), F.col(text_col).alias("text"))
    return predict(rows, model, keep=["held_out"])


def third_held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from those with crc32(doc_id) mod 3 not 1."""
    return identify(table(spark, sf_dir, "documents"), third_held_out())
