"""Train/test split, class weights and the fingerprint of training inputs."""
from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Hexadecimal digits of the split hash, and those that one round of the exact hold-out tells apart.
HASH_DIGITS, DIGITS = 32, 3


def split_hash(customer_id: Column, seed: int) -> Column:
    return F.md5(F.concat_ws("|", customer_id.cast("string"), F.lit(str(seed))))


def is_test(customer_id: Column, test_size: float = 0.2, seed: int = 42) -> Column:
    """Deterministic hold-out by hash: no shuffle, independent of row order, and
    stable for a customer when others come and go."""
    if not 0.0 < test_size < 1.0:
        raise ValueError(f"test_size must lie between 0 and 1, got {test_size}")
    bound = f"{min(int(test_size * 0x100000000), 0xFFFFFFFF):08x}"
    return F.substring(split_hash(customer_id, seed), 1, 8) < F.lit(bound)


def stratified_bounds(df: DataFrame, test_size: float = 0.2, seed: int = 42, label: str = "churn") -> dict:
    """By class, the largest hash of its hold-out: round(test_size * rows) rows of the class lie at or below it.

    Radix selection: a histogram of the next hash digits per class tells in which digits the last row lies, and only
    the rows there are counted again by the digits that follow. Each round shuffles and collects at most
    ``16 ** DIGITS`` counts per class; no row is sorted. For labels of a few classes, NULL one of them. ``df`` is read
    once a round (two or three rounds up to billions of rows), so a costly one should be a stored table.
    """
    if not 0.0 < test_size < 1.0:
        raise ValueError(f"test_size must lie between 0 and 1, got {test_size}")
    hashed = df.select(F.col(label).alias("_class"), split_hash(F.col("customer_id"), seed).alias("_hash"))
    bounds: dict = {}
    open_: dict | None = None  # class: hash digits known so far, rows still to take among those that begin with them
    depth = 0
    while open_ is None or open_:
        rows = hashed if open_ is None else hashed.where(reduce(Column.__or__, [
            F.col("_class").eqNullSafe(F.lit(c)) & F.col("_hash").startswith(known) for c, (known, _) in open_.items()]))
        digits = F.substring("_hash", depth * DIGITS + 1, DIGITS)
        histogram: dict = {}
        for c, part, n in rows.groupBy("_class", digits.alias("_part")).count().collect():
            histogram.setdefault(c, []).append((part, n))
        if open_ is None:
            sizes = {c: sum(n for _, n in parts) for c, parts in histogram.items()}
            open_ = {c: ("", math.floor(n * test_size + 0.5)) for c, n in sizes.items()}
            bounds = dict.fromkeys(sizes, "")
        further = {}
        for c, (known, left) in open_.items():
            for part, n in sorted(histogram[c]):
                if not left:
                    break
                bounds[c] = known + part
                if n > left and len(known + part) < HASH_DIGITS:
                    further[c] = (known + part, left)
                    break
                left -= min(n, left)
        open_, depth = further, depth + 1
    return {c: known.ljust(HASH_DIGITS, "f") if known else "" for c, known in bounds.items()}


def stratified_test_flags(df: DataFrame, test_size: float = 0.2, seed: int = 42, label: str = "churn") -> DataFrame:
    """Adds ``is_test`` with an exact share per class: within each class the customers with the smallest hashes, up to
    round(test_size * class size). The bounds are literals, so nothing is shuffled for the flag; rows of one customer
    share a hash and stay on one side."""
    own = split_hash(F.col("customer_id"), seed)
    flags = [F.when(F.col(label).eqNullSafe(F.lit(c)), own <= F.lit(bound))
             for c, bound in stratified_bounds(df, test_size, seed, label).items()]
    return df.withColumn("is_test", F.coalesce(*flags, F.lit(False)))


def class_weights(df: DataFrame, label: str = "churn") -> DataFrame:
    """(label, rows, weight): n / (classes * rows of the class), so classes weigh the same."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    whole = counts.agg(F.struct(F.sum("rows").alias("n"), F.count(F.lit(1)).alias("classes")).alias("w")).scalar()
    return counts.select(label, "rows", whole.alias("w")).select(
        label, "rows", (F.col("w.n") / (F.col("w.classes") * F.col("rows"))).alias("weight"))


def with_class_weight(df: DataFrame, label: str = "churn") -> DataFrame:
    """Adds ``weight``. A row without a label is an error, not a row less."""
    known = df.withColumn(label, F.coalesce(label, F.raise_error(F.lit(f"NULL in {label}")).cast(df.schema[label].dataType)))
    return known.join(class_weights(df, label).select(label, "weight"), label)


def input_fingerprint(table: DataFrame, settings: dict[str, str], label: str = "churn",
                      content: Sequence[str] = ()) -> DataFrame:
    """One row (rows, churn_mean, fingerprint): SHA-1 over the settings, the row
    count, the mean label and, when ``content`` names columns, their values.

    The content digest is an order-free XOR of row hashes, so it needs no sort.
    """
    digest = F.hex(F.bit_xor(F.xxhash64(*content))) if content else F.lit("")
    facts = table.agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.coalesce(F.avg(label), F.lit(0.0)), 6).alias("churn_mean"),
        digest.alias("content"),
    )
    parts = [F.lit(f"{k}={settings[k]}") for k in sorted(settings)]
    text = F.concat_ws(";", *parts, F.format_string("rows=%d", "rows"),
                       F.format_string("churn_mean=%.6f", "churn_mean"), F.concat(F.lit("content="), "content"))
    return facts.select("rows", "churn_mean", F.sha1(text).alias("fingerprint"))
