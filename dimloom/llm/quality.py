"""Quality rules: exact text statistics and a trained, calibrated classifier.

The classifier is a logistic regression over hashed word 1- and 2-grams and
hashed character 4-grams (bytes). It is fitted on a bounded sample of
labelled rows (``SAMPLE_ROWS``, chosen by a hash of the id), calibrated on a
held-out fifth of it (Platt scaling), and scored in Arrow batches over every
whole text against the fixed threshold ``KEEP_AT``.

Defined results: a null text has no words (so the base rules fail it); an
empty table gives an empty result; repeated rows are scored alike; with no
labels, or labels of one class, only the base rules decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimloom.llm.words import Words, mix, powers, slices

U = np.uint64
#: The most labelled rows that a fit reads.
SAMPLE_ROWS = 3_000
#: A text is kept at this calibrated probability of good quality, or more.
KEEP_AT = 0.3
BITS = 16
CHAR_SIZES = (4,)
EPOCHS = 40
SYMBOLS = "[#*$%&|<>]"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in SYMBOLS[1:-1]]] = True

STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


@dataclass
class Model:
    """Weights of the hashed features, and slope and offset of the calibration."""
    weights: np.ndarray
    slope: float
    offset: float

    def probability(self, score: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * score + self.offset, -40, 40)))


def repeated(group: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values occur twice or more in their group; which of these aren't the first."""
    key = mix(values ^ mix(group.astype(U) + U(1)))
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = ordered[1:] == ordered[:-1]
    twice, later = np.zeros(len(key), bool), np.zeros(len(key), bool)
    twice[order] = same[1:] | same[:-1]
    later[order] = same[:-1]
    return twice, later


def per_text(marks: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.zeros(len(marks) + 1, np.int64)
    np.cumsum(marks, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def statistics(w: Words) -> dict[str, np.ndarray]:
    """Words, code points in words, symbols, duplicate lines and repeated words of each text."""
    begins = (w.data & 0xC0) != 0x80  # one byte of each code point
    total = np.zeros(len(w.data) + 1, np.int64)
    np.cumsum(begins, out=total[1:])
    chars = np.zeros(len(w.start) + 1, np.int64)
    np.cumsum(total[w.end] - total[w.start], out=chars[1:])

    edge = np.ones(len(w.data) + 1, bool)
    edge[:-1] = w.data == 10
    edge[w.at] = True
    stop = np.flatnonzero(edge)  # lines end before a newline and where a text ends
    start = np.concatenate([[0], stop[:-1] + (w.data[np.minimum(stop[:-1], len(w.data) - 1)] == 10)]) if len(w.data) else np.zeros(1, np.int64)
    has_word = np.searchsorted(w.start, stop) > np.searchsorted(w.start, start)
    start, stop = start[has_word], stop[has_word]
    of = np.searchsorted(w.at, start, side="right") - 1
    _, later = repeated(of, w.spans(start, stop))

    first, hashes = w.windows(5)
    twice, _ = repeated(w.text[first], hashes)
    cover = np.zeros(len(w.start) + 1, np.int64)
    np.add.at(cover, first[twice], 1)
    np.add.at(cover, first[twice] + 5, -1)
    return {"n_words": w.count, "word_chars": chars[w.first[1:]] - chars[w.first[:-1]], "n_symbols": per_text(_SYMBOL[w.data], w.at),
            "n_dup_lines": np.bincount(of[later], minlength=w.texts), "n_repeat_words": per_text(np.cumsum(cover)[:-1] > 0, w.first)}


def features(w: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each family of n-grams: (text, feature) of every occurrence."""
    found = []
    for size in (1, 2):
        at, hashes = w.windows(size)
        found.append((w.text[at], hashes))
    n = len(w.data)
    of = np.repeat(np.arange(w.texts), np.diff(w.at))
    for size in CHAR_SIZES:
        m = max(0, n - size + 1)
        hashes = np.zeros(m, U)
        for k, factor in enumerate(powers(0x9E3779B97F4A7C15, size + 1)[1:]):
            hashes += (w.data[k:k + m].astype(U) + U(1)) * factor
        inside = of[:m] == of[size - 1:]
        found.append((of[:m][inside], mix(hashes[inside])))
    return [(text, ((family << BITS) + (h >> U(64 - BITS)).astype(np.int64))) for family, (text, h) in enumerate(found)]


def scores(w: Words, weights: np.ndarray) -> np.ndarray:
    """For each text the sum over families of the mean weight of their n-grams."""
    out = np.full(w.texts, float(weights[-1]))
    for text, feature in features(w):
        out += np.bincount(text, weights[feature], minlength=w.texts) / np.maximum(np.bincount(text, minlength=w.texts), 1)
    return out


def fit(texts: pa.Array, good: np.ndarray, held: np.ndarray) -> Model | None:
    """Fit on the rows outside ``held`` and calibrate on those inside; None if a side lacks a class."""
    if any(len(np.unique(good[part])) < 2 for part in (held, ~held)):
        return None
    size, n_texts = (2 + len(CHAR_SIZES)) << BITS, len(texts)
    rows, columns, values, before = [], [], [], 0
    # slice by slice: only a text's distinct features are kept, never all occurrences of the sample
    for part in slices(pa.record_batch([texts], ["text"]), "text"):
        w = Words(part.column("text"))
        for text, feature in features(w):
            cell, n = np.unique(text * size + feature, return_counts=True)
            row = cell // size
            rows.append((row + before).astype(np.int32))
            columns.append((cell % size).astype(np.int32))
            values.append(n / np.maximum(np.bincount(text, minlength=w.texts), 1)[row])
        before += w.texts
    row, column, value = (np.concatenate(x) for x in (rows, columns, values))
    used = ~held[row]
    r, c, v = row[used], column[used], value[used]
    weights, step = np.zeros(size + 1), np.full(size + 1, 1e-8)
    n = max(1, int((~held).sum()))
    for _ in range(EPOCHS):  # full-batch AdaGrad
        score = np.bincount(r, weights[c] * v, minlength=n_texts) + weights[-1]
        error = np.where(held, 0, 1 / (1 + np.exp(-np.clip(score, -40, 40))) - good) / n
        gradient = np.bincount(c, error[r] * v, minlength=size + 1) + 1e-7 * weights
        gradient[-1] = error.sum()
        step += gradient * gradient
        weights -= 0.5 * gradient / np.sqrt(step)
    score = np.bincount(row, weights[column] * value, minlength=n_texts) + weights[-1]
    return Model(weights, *platt(score[held], good[held]))


def platt(score: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through held-out scores (targets smoothed as by Platt)."""
    n1, n0 = good.sum(), (1 - good).sum()
    target = np.where(good > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([score, np.ones_like(score)], 1)
    b = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -40, 40)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        b = b + np.linalg.solve(h, x.T @ (target - p) - 1e-6 * b)
    return float(b[0]), float(b[1])


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Fit on at most ``sample_rows`` labelled documents, in one task over that bounded sample.

    Ids with a null or contradictory label, and null ids, aren't used.
    """
    spark = docs.sparkSession
    known = (labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
             .agg(F.min("quality").alias("good"), F.max("quality").alias("_top")).where("good = _top"))
    order = F.xxhash64("doc_id", F.lit(7))
    # sample_rows bounds this list of ids
    ids = [tuple(r) for r in known.orderBy(order, "doc_id").limit(sample_rows).select("doc_id", "good", F.pmod(order, F.lit(5)).alias("fold")).collect()]
    if not ids:
        return None
    chosen = spark.createDataFrame(ids, "doc_id long, good int, fold long")
    sample = (docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id")
              .groupBy("doc_id").agg(F.max("text").alias("text"), F.max("good").alias("good"), F.max("fold").alias("fold")))

    def fit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches, SAMPLE)
        model = fit(table["text"].combine_chunks(), table["good"].to_numpy().astype(float), table["fold"].to_numpy() == 0) if table.num_rows else None
        if model:
            yield pa.RecordBatch.from_pydict({"weights": [model.weights.astype(np.float32).tobytes()], "slope": [model.slope], "offset": [model.offset]})

    found = sample.select("doc_id", "text", "good", "fold").repartition(1).sortWithinPartitions("doc_id").mapInArrow(fit_rows, "weights binary, slope double, offset double").collect()
    return Model(np.frombuffer(found[0][0], np.float32).astype(float), found[0][1], found[0][2]) if found else None


SAMPLE = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("good", pa.int32()), ("fold", pa.int64())])


def quality_rules(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with statistics, ``base_failed``, ``probability`` and ``kept`` added (own columns of these names are replaced)."""
    added = f"{STATS}, base_failed boolean, probability double, kept boolean"
    names = [x.split()[0] for x in added.split(", ")]
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in names])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                w = Words(part.column(text))
                found = statistics(w)
                failed = (w.count < 10) | (100 * found["n_repeat_words"] > 20 * w.count)
                p = shared.value and shared.value.probability(scores(w, shared.value.weights))
                kept = ~failed if p is None else ~failed & (p >= KEEP_AT)
                columns = [pa.array(found[n].astype(np.int64)) for n in names[:5]] + [pa.array(failed), pa.nulls(w.texts, pa.float64()) if p is None else pa.array(p), pa.array(kept)]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], [*part.schema.names, *names])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", " + added
    return docs.mapInArrow(score, schema)
