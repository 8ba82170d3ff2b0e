"""Quality by Bradley-Terry ranking: scores learnt from preference pairs.

A document's score is a weighted sum of measures of its text. Of a preferred and a rejected document the
preferred one should score higher: the weights minimise the logistic loss of the pairs' differences. The
threshold is the quantile of the labelled documents' scores at the share of rejected ones.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitf.llm.labelled import fold, labelled_texts, logistic, newton, quantile, sigmoid
from pitf.session import materialise
from pitf.llm.textcore import chain, lowered, slices, span_hashes, text_bytes, words

#: Pairs per rejected document.
PAIRS = 30


def measures(column: pa.Array) -> np.ndarray:
    """One row of plain text measures per document, for a whole Arrow column at once."""
    data, offsets = text_bytes(column)
    n = len(offsets) - 1
    start, end, doc = words(data, offsets)
    length = end - start
    hashes = span_hashes(lowered(data), start, end)
    bounds = np.searchsorted(doc, np.arange(n + 1))
    n_words = np.diff(bounds)

    def per_doc(values: np.ndarray) -> np.ndarray:
        return np.bincount(doc, values, n)

    def bytes_in(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask)))
        return total[offsets[1:]] - total[offsets[:-1]]

    def repeated(keys: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Per document the number of entries that occurred before in it."""
        order = np.lexsort((keys, owner))
        same = (keys[order][1:] == keys[order][:-1]) & (owner[order][1:] == owner[order][:-1])
        return np.bincount(owner[order][1:][same], minlength=n) if len(keys) else np.zeros(n)

    upper = (data >= 65) & (data <= 90)
    accented = np.concatenate(([False], (data[1:] >= 0x80) & (data[1:] < 0x9F) & (data[:-1] == 0xC3))) if len(data) else upper
    lower = (data >= 97) & (data <= 122)
    digit = (data >= 48) & (data <= 57)
    marks = np.isin(data, np.frombuffer(b"#$%&*@^~<>=+_{}[]\\/", np.uint8))
    letters = np.maximum(bytes_in(upper | lower | accented), 1)
    size = np.maximum(np.diff(offsets), 1)
    of_words = np.maximum(n_words, 1)
    last = data[end - 1] if len(end) else data[:0]
    threes = chain([hashes[i:len(hashes) - 2 + i] for i in range(3)]) if len(hashes) > 2 else hashes[:0]
    inside = doc[2:] == doc[:-2] if len(hashes) > 2 else np.zeros(0, bool)
    follows = np.concatenate(([False], (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1]))) if len(doc) else np.zeros(0, bool)
    newline = np.flatnonzero(data == 10)
    columns = [
        np.log1p(n_words), np.log1p(size), per_doc(length) / of_words,
        bytes_in(upper | accented) / letters, bytes_in(digit) / size, bytes_in(marks) / size,
        bytes_in(data == 33) / of_words, bytes_in(data == 124) / of_words, bytes_in(data == 46) / of_words,
        bytes_in(data == 44) / of_words, np.bincount(np.searchsorted(offsets, newline, "right") - 1, minlength=n)[:n] / of_words,
        repeated(hashes, doc) / of_words, repeated(threes[inside], doc[2:][inside] if len(doc) > 2 else doc[:0]) / of_words,
        per_doc(follows) / of_words, per_doc(length > 12) / of_words, per_doc(length < 4) / of_words,
        per_doc((last >= 33) & (last <= 47) & (last != 46) & (last != 44)) / of_words,
        bytes_in(data >= 128) / size,
    ]
    return np.stack(columns, axis=1)


def expand(x: np.ndarray, middle: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Each measure, standardised and within bounds, and how far it lies outside its usual range on either side."""
    z = np.clip((x - middle) / spread, -8, 8)
    return np.concatenate((z, np.maximum(z - .5, 0), np.maximum(-z - .5, 0)), axis=1)


@dataclass
class RankModel:
    middle: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float
    scale: float

    def scores(self, column: pa.Array) -> np.ndarray:
        raw = expand(measures(column), self.middle, self.spread) @ self.weights
        return sigmoid((raw - self.threshold) * self.scale)


def fit(rows: list[tuple[str, int]]) -> RankModel:
    """From (text, quality) rows; with one class only, every score is that class."""
    y = np.array([label for _, label in rows])
    parts = [measures(pa.array([t for t, _ in rows[i:i + 500]], pa.large_string())) for i in range(0, len(rows), 500)]
    x = np.concatenate(parts) if parts else measures(pa.array([""], pa.large_string()))
    middle, spread = np.median(x, axis=0), x.std(axis=0) + 1e-6
    z = expand(x, middle, spread)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return RankModel(middle, spread, np.zeros(z.shape[1]), -30.0 if len(good) else 30.0, 1.0)
    draw = np.random.default_rng(7)
    preferred = good[draw.integers(0, len(good), len(bad) * PAIRS)]
    difference = z[preferred] - z[np.repeat(bad, PAIRS)]
    weights = logistic(difference, np.ones(len(difference)), ridge=1e-3)
    raw = z @ weights
    threshold = float(np.quantile(raw, (y == 0).mean()))
    # Monotone stretch of the margin to a probability; the ranking and the threshold stay as they are.
    scale = float(logistic((raw - threshold)[:, None], y.astype(float), 1e-6)[0])
    return RankModel(middle, spread, weights, threshold, max(scale, 1e-3))


def _scorer(model: RankModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__pitf_text"):
            scores = model.scores(batch.column(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())],
                                             [*batch.schema.names[:-1], "_score"])
    return run


def score(docs: DataFrame, model: RankModel, text_col: str = "text", keep: tuple[str, ...] | None = None) -> DataFrame:
    """Columns ``keep`` (default: all) and ``_score``, 0 to 1, above one half where the text ranks over the threshold.

    A null or empty text has measures of 0; repeated rows score alike; an empty table gives no rows. A column
    ``_score`` is replaced; names that begin with ``__pitf`` are reserved.
    """
    docs = docs.drop("_score")
    texts = docs.select(*(docs.columns if keep is None else keep), F.col(text_col).alias("__pitf_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema.fields[:-1])
    return texts.mapInArrow(_scorer(model), f"{fields}, _score double")


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "__pitf_text"):
        x = measures(batch.column(batch.num_columns - 1))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *(pa.array(x[:, i], pa.float64()) for i in range(x.shape[1]))],
                                         [*batch.schema.names[:-1], *(f"_m{i}" for i in range(x.shape[1]))])


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None, label: str = "quality") -> RankModel:
    """Fit on every usable labelled row, on Spark: the same model as ``fit``, with pairs drawn by the hash of ids."""
    usable = fold("doc_id", 3) != 1 if usable is None else usable
    rows = labelled_texts(docs, labels, label, usable)
    n_measures = measures(pa.array([""], pa.large_string())).shape[1]
    names = [f"_m{i}" for i in range(n_measures)]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    x = materialise(rows.mapInArrow(_measured, f"{fields}, {', '.join(f'{m} double' for m in names)}"), "quality_measures")
    counts = x.agg(F.count(F.lit(1)).alias("n"), F.sum("_label").alias("good")).first()
    n, n_good = counts["n"], int(counts["good"] or 0)
    if not n:
        return fit([])
    spread = np.array(list(x.agg(*(F.stddev_pop(m) for m in names)).first()), float) + 1e-6
    middle = np.array([quantile(x, m, .5, n) for m in names])
    if not n_good or n_good == n:
        return RankModel(middle, spread, np.zeros(3 * n_measures), -30.0 if n_good else 30.0, 1.0)
    z = [F.least(F.greatest((F.col(m) - float(middle[i])) / float(spread[i]), F.lit(-8.0)), F.lit(8.0)) for i, m in enumerate(names)]
    z = z + [F.greatest(c - .5, F.lit(0.0)) for c in z] + [F.greatest(-c - .5, F.lit(0.0)) for c in z]
    zs = x.select("doc_id", "_label", F.array(*z).alias("_z"))
    good = zs.where("_label = 1").select("_z").rdd.zipWithIndex().map(lambda r: (r[1], r[0][0])).toDF("_i bigint, _g array<double>")
    # Spark counts an array as one element: the planner's estimate of the pairs is far too low for a broadcast.
    pairs = (zs.where("_label = 0").select("doc_id", "_z", F.explode(F.sequence(F.lit(0), F.lit(PAIRS - 1))).alias("_j"))
             .withColumn("_i", F.pmod(F.xxhash64(F.col("doc_id").cast("string"), "_j"), F.lit(n_good)))
             .join(good.hint("merge"), "_i").select(F.zip_with("_g", "_z", lambda a, b: a - b).alias("_x"), F.lit(1.0).alias("_y")))
    weights = newton(materialise(pairs, "quality_pairs"), 3 * n_measures, ridge=1e-3)
    raw = F.aggregate(F.zip_with("_z", F.array(*(F.lit(float(w)) for w in weights)), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    scored = materialise(zs.select(raw.alias("_raw"), F.col("_label").cast("double").alias("_y")), "quality_raw")
    threshold = quantile(scored, "_raw", (n - n_good) / n, n)
    # Monotone stretch of the margin to a probability; the ranking and the threshold stay as they are.
    scale = float(newton(scored.select(F.array(F.col("_raw") - threshold).alias("_x"), "_y"), 1, ridge=1e-6)[0])
    return RankModel(middle, spread, weights, threshold, max(scale, 1e-3))
