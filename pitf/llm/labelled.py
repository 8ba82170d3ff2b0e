"""Labelled rows (bounded samples or all of them) and logistic fits, local or on Spark, shared by the classifiers."""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; a null id is in fold 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds)), F.lit(0))


def sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, bound: int, id_col: str = "doc_id",
           text_col: str = "text") -> list[tuple[str, int]]:
    """(text, label) of at most ``bound`` labelled rows where ``usable``, by the hash of their ids.

    The bound is on rows, chosen before texts are read; texts are whole. Rows without id, label or text are left
    out; an id labelled twice takes the larger label.
    """
    named = (labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull()).where(usable)
             .groupBy(id_col).agg(F.max(label).cast("int").alias("_label")))
    present = docs.where(F.col(text_col).isNotNull()).select(id_col).distinct()
    chosen = (named.join(present, id_col, "left_semi")
              .orderBy(F.xxhash64(F.col(id_col).cast("string")), id_col).limit(bound))
    texts = docs.select(id_col, F.col(text_col).alias("__pitf_text")).where("__pitf_text IS NOT NULL").join(F.broadcast(chosen), id_col)
    rows = texts.groupBy(id_col, "_label").agg(F.min("__pitf_text").alias("__pitf_text")).select("__pitf_text", "_label")
    return sorted((r[0], int(r[1])) for r in rows.toLocalIterator())


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Weights of the regularised logistic loss by Newton's method; no intercept of its own."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) / len(y) + ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x / len(y) + ridge * np.eye(x.shape[1])
        move = np.linalg.solve(curve, gradient)
        w -= move
        if np.abs(move).max() < 1e-8:
            break
    return w


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, usable: Column, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(id, _label, __pitf_text) of every labelled row where ``usable``, by the rules of ``sample`` without its bound."""
    named = (labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull()).where(usable)
             .groupBy(id_col).agg(F.max(label).cast("int").alias("_label")))
    texts = docs.select(id_col, F.col(text_col).alias("__pitf_text")).where("__pitf_text IS NOT NULL").join(named, id_col)
    return texts.groupBy(id_col, "_label").agg(F.min("__pitf_text").alias("__pitf_text"))


def quantile(df: DataFrame, col: str, q: float, n: int, accuracy: int = 10_000) -> float:
    """``np.quantile`` (linear) of a column of ``n`` non-null rows, exact: an approximate bracket, then its values counted."""
    h = (n - 1) * q
    k = int(np.floor(h))
    wanted = [k, min(k + 1, n - 1)]
    width = 4.0 / accuracy
    while True:
        low_q, high_q = max(0.0, q - width), min(1.0, q + width)
        low, high = df.agg(F.percentile_approx(col, [low_q, high_q], accuracy)).first()[0]
        low = low if low_q > 0 else df.agg(F.min(col)).first()[0]
        high = high if high_q < 1 else df.agg(F.max(col)).first()[0]
        below = df.where(F.col(col) < low).count()
        values = df.where(F.col(col).between(low, high)).groupBy(col).count().orderBy(col).collect()
        inside = sum(r[1] for r in values)
        if below <= wanted[0] and wanted[1] < below + inside:
            found, seen = [], below
            for value, count in values:
                seen += count
                found += [value] * sum(1 for i in wanted if seen - count <= i < seen)
            return float(found[0] + (h - k) * (found[1] - found[0]))
        width *= 4


def newton(data: DataFrame, dim: int, ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """``logistic`` over rows (``_x`` array of ``dim`` doubles, ``_y``) on Spark: each step sums the tasks' parts."""
    import pyarrow as pa
    n = data.count()
    w = np.zeros(dim)
    for _ in range(steps):
        def part(batches, w=w):
            total = np.zeros(dim + dim * dim)
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                y = batch.column(1).to_numpy(zero_copy_only=False)
                p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
                total += np.concatenate((x.T @ (p - y), ((x * (p * (1 - p))[:, None]).T @ x).ravel()))
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["_part"])
        total = sum((np.frombuffer(r[0]) for r in data.select("_x", "_y").mapInArrow(part, "_part binary").collect()),
                    np.zeros(dim + dim * dim))
        gradient = total[:dim] / n + ridge * w
        curve = total[dim:].reshape(dim, dim) / n + ridge * np.eye(dim)
        move = np.linalg.solve(curve, gradient)
        w = w - move
        if np.abs(move).max() < 1e-8:
            break
    return w
