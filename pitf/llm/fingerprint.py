"""Context-triggered piecewise hashing of texts and the likeness of two fingerprints.

A rolling hash of the last ``WINDOW`` bytes ends a chunk wherever it falls on the block size's trigger value.
Each chunk gives one of 64 characters, so an edit changes the characters near it and no others. The block
size grows in doublings with the text so that a signature has about ``LENGTH`` characters; a fingerprint holds
the signatures at that size and the next one: ``size:signature:signature``. Two fingerprints are compared by
edit distance where they have a common block size.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitf.llm.textcore import MULTIPLIER, mix, powers
from pitf.session import materialise

WINDOW = 7
LENGTH = 64
SMALLEST = 3
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
#: Signatures without a common run of so many characters (or of the whole shorter one) are unlike.
COMMON_RUN = 7
_LETTERS = np.frombuffer(ALPHABET.encode(), np.uint8)
_WEIGHTS = np.array([pow(0x01000193, i, 1 << 32) for i in range(WINDOW)], np.uint32)
#: Bytes hashed at once; the chunk that is open at the end of a part goes on in the next.
PART = 1 << 20


def _rolling(data: np.ndarray) -> np.ndarray:
    """For each byte a 32-bit hash of it and the ``WINDOW`` - 1 before it."""
    wide = data.astype(np.uint32)
    out = wide * _WEIGHTS[0]
    for back in range(1, WINDOW):
        out[back:] += wide[:-back] * _WEIGHTS[back] if len(wide) > back else 0
    out ^= out >> np.uint32(15)
    out *= np.uint32(0x2C1B3C6D)
    return out ^ (out >> np.uint32(12))


def _signature(data: np.ndarray, rolled: np.ndarray, block: int) -> str:
    ends = np.flatnonzero(rolled % np.uint32(block) == block - 1) + 1
    if not len(data):
        return ""
    if not len(ends) or ends[-1] < len(data):
        ends = np.append(ends, len(data))
    starts = np.concatenate(([0], ends[:-1]))
    lengths = ends - starts
    total = np.zeros(len(ends), np.uint64)
    power = powers(min(int(lengths.max()), PART))
    for lo in range(0, len(data), PART):
        hi = min(lo + PART, len(data))
        first, last = np.searchsorted(ends, lo, "right"), np.searchsorted(ends, hi - 1, "right")
        at = np.maximum(starts[first:last + 1], lo) - lo
        place = (np.arange(lo, hi) - np.repeat(starts[first:last + 1], np.diff(np.append(at, hi - lo)))) % len(power)
        total[first:last + 1] += np.add.reduceat((data[lo:hi].astype(np.uint64) + np.uint64(1)) * power[place], at)
    letters = mix(total * np.uint64(MULTIPLIER) + lengths.astype(np.uint64)) & np.uint64(63)
    return _LETTERS[letters.astype(np.intp)].tobytes().decode()


def fingerprint(data: bytes) -> str:
    """``size:signature:signature`` of the whole bytes; no bytes give ``3::``."""
    values = np.frombuffer(data, np.uint8)
    block = SMALLEST
    while block * LENGTH < len(values):
        block *= 2
    rolled = _rolling(values)
    sign = _signature(values, rolled, block)
    while block > SMALLEST and len(sign) < LENGTH // 2:
        block //= 2
        sign = _signature(values, rolled, block)
    return f"{block}:{sign}:{_signature(values, rolled, 2 * block)}"


def edit_distance(a: str, b: str) -> int:
    """Insertions, deletions and replacements, a column of the table as the bits of one number."""
    if not a or not b:
        return len(a) + len(b)
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    plus, minus, distance = full, 0, len(a)
    for c in b:
        equal = places.get(c, 0)
        diagonal = (((equal & plus) + plus) ^ plus) | equal | minus
        up = minus | ~(diagonal | plus) & full
        down = plus & diagonal
        distance += bool(up & top) - bool(down & top)
        up = up << 1 | 1
        plus = (down << 1 | ~(diagonal | up)) & full
        minus = up & diagonal & full
    return distance


def _like(a: str, b: str) -> float:
    if a == b:
        return 1.0
    run = min(COMMON_RUN, len(a), len(b))
    if not run or not {a[i:i + run] for i in range(len(a) - run + 1)} & {b[i:i + run] for i in range(len(b) - run + 1)}:
        return 0.0
    return 1 - edit_distance(a, b) / max(len(a), len(b))


def likeness(a: str, b: str) -> float:
    """0 to 1: the best of the signatures with equal block size; 0 if there is none, 1 for equal fingerprints."""
    if a == b:
        return 1.0
    (size_a, *signs_a), (size_b, *signs_b) = a.split(":"), b.split(":")
    mine = {int(size_a): signs_a[0], 2 * int(size_a): signs_a[1]}
    other = {int(size_b): signs_b[0], 2 * int(size_b): signs_b[1]}
    return max((_like(mine[k], other[k]) for k in mine.keys() & other.keys()), default=0.0)


def edited(text: str, following: str) -> str:
    """The last floor(n / 2) code points replaced by the first as many (or all) of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by slice and id; the last of a slice is its successor's first document (``borrowed``)."""
    names = ["id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "next_fingerprint", "near_edited", "near_next"]
    before, kind = None, None

    def row(this, text, printed):
        changed = edited(this[1], text)
        mine = this[2]
        again = fingerprint(changed.encode())
        return (this[0], len(this[1]), changed, mine, again, printed, likeness(mine, again), likeness(mine, printed))

    for batch in batches:
        kind = batch.schema.field(1).type
        for at in range(0, len(batch), 256):
            out = []
            for part, key, borrowed, text in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns), strict=True):
                text = text or ""
                printed = fingerprint(text.encode())
                if before and before[3] == part and not before[4]:
                    out.append(row(before, text, printed))
                if not (before and before[3] == part and before[4]):
                    before = (key, text, printed, part, borrowed)
            columns = list(zip(*out, strict=True)) or [[]] * 8
            kinds = (kind, pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def compare_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       slices: int | None = None) -> DataFrame:
    """Fingerprints of every text, of the text edited with the next document's beginning, and their likenesses.

    ``id_col``, ``n_chars``, ``edited`` (the text), ``fingerprint``, ``edited_fingerprint``, ``next_fingerprint``,
    ``near_edited``, ``near_next``. Next is by ascending id, then text; after the last comes the first, and a
    single row follows itself. Null ids come first; a null text is empty; repeated rows follow one another; other
    columns are ignored; an empty table gives no rows.

    Documents go to slices of the id range (a fixed list of bounds, so a retried task sees the same ones), and the
    first of each slice also to the end of the slice before it: texts are shuffled once.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    slices = slices or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = texts.agg(F.percentile_approx("id", [i / slices for i in range(1, slices)], 10_000)).first()[0] if slices > 1 else []
    splits = [-math.inf, *sorted({float(x) for x in bounds or []}), math.inf]
    placed = texts.withColumn("number", F.col("id").cast("double")).withColumn("slice", F.lit(0.0))
    if len(splits) > 2:
        placed = Bucketizer(splits=splits, inputCol="number", outputCol="slice", handleInvalid="keep").transform(
            placed.drop("slice"))
    placed = placed.drop("number").withColumn("slice", F.when(F.col("id").isNull(), -1).otherwise(F.col("slice")).cast("int"))
    # One row per slice: its first id and the slice before it (before the first: the last).
    firsts = materialise(placed.groupBy("slice").agg(F.min("id").alias("first")), "firsts")
    order = Window.orderBy("slice")
    last = F.max("slice").over(Window.partitionBy())
    lenders = materialise(firsts.withColumn("to", F.coalesce(F.lag("slice").over(order), last)), "lenders")
    lent = (placed.drop("slice").join(lenders.select("first", F.col("to").alias("slice")),
                                      placed["id"].eqNullSafe(F.col("first"))).drop("first")
            .withColumn("borrowed", F.lit(True)))
    # Of equal ids the first text alone is needed; the reader passes over the others.
    both = placed.withColumn("borrowed", F.lit(False)).unionByName(lent)
    kind = texts.schema["id"].dataType.simpleString()
    schema = (f"id {kind}, n_chars long, edited string, fingerprint string, edited_fingerprint string, "
              "next_fingerprint string, near_edited double, near_next double")
    return (both.select("slice", "id", "borrowed", "text").repartition("slice")
            .sortWithinPartitions("slice", "borrowed", F.col("id").asc_nulls_first(), "text")
            .mapInArrow(_compare, schema).withColumnRenamed("id", id_col))
