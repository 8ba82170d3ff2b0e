"""Exact quantiles, for few distinct values and for any number of them."""
from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitf.operators.prefix import join_groups, running_totals
from pitf.session import materialise

# Rank accuracy of the approximate quantiles that bracket the exact ones.
ACCURACY = 10000


def discrete_quantile(df: DataFrame, value: Column, q: float) -> DataFrame:
    """One row ``value``: the smallest element whose rank reaches ``q`` of all rows.

    For integer values of bounded variety: day counts (bounded by the calendar)
    or events per customer (N events give fewer than sqrt(2N) distinct counts).
    Only the distinct values are ordered, never the rows. NULL for no rows.
    """
    counts = df.select(value.alias("value")).where("value IS NOT NULL").groupBy("value").count()
    so_far = Window.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.select(
        "value", F.sum("count").over(so_far).alias("upto"),
        F.sum("count").over(Window.partitionBy()).alias("n"))
    return ranked.where(F.col("upto") >= F.ceil(F.col("n") * F.lit(q))).agg(F.min("value").alias("value"))


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], groups: Sequence[str] = ()) -> DataFrame:
    """(groups, prob, quantile) with linear interpolation between order statistics.

    An exact percentile aggregate would hold every distinct value of a group in
    one task. Here a first pass brackets each quantile between two approximate
    ones; a second pass counts the rows between brackets and keeps values only
    inside them, a fraction of about ``8 / ACCURACY`` per quantile. Running
    totals over what is left give exact ranks. Should a rank fall outside its
    bracket, the brackets are widened until none does. ``df`` is read twice, so a
    costly one should be a stored table.
    """
    groups, probs = list(groups), [float(p) for p in probs]
    rows = df.select(*groups, F.col(value).cast("double").alias("_v")).where("_v IS NOT NULL")
    slack = 4.0 / ACCURACY
    hits = _ranked_hits(rows, probs, groups, slack)
    found = []
    while slack < 1.0 and not hits.where("_gap").isEmpty():
        slack *= 16
        if groups:  # only the groups on this work list are read again
            missed = materialise(hits.where("_gap").select(F.struct(*groups).alias("_missed")).distinct(), "missed")
            found.append(hits.join(missed, F.struct(*groups) == F.col("_missed"), "left_anti"))
            rows = rows.join(missed, F.struct(*groups) == F.col("_missed"), "left_semi")
        hits = _ranked_hits(rows, probs, groups, slack)
    return _interpolated(reduce(DataFrame.unionByName, found, hits), groups)


def _interpolated(hits: DataFrame, groups: list[str]) -> DataFrame:
    ends = hits.groupBy(*groups, F.col("h.prob").alias("prob")).agg(
        F.max(F.when(F.col("h.is_low"), F.col("_at"))).alias("low"),
        F.max(F.when(F.col("h.is_high"), F.col("_at"))).alias("high"),
        F.max("h.weight").alias("weight"))
    return ends.select(
        *groups, "prob", (F.col("low") + (F.col("high") - F.col("low")) * F.col("weight")).alias("quantile"))


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(feature, prob, quantile) of many columns at once, exact as ``exact_quantiles``; all-NULL columns give no rows.

    One sketch per column in a single aggregation brackets the quantiles; the few bounds come to the driver and
    become literals. One more pass turns each row into an array with every column's place among its brackets, counted
    by task, with the value itself only inside a bracket. Columns with a rank outside its bracket alone go round again.
    """
    columns, probs, slack = list(columns), [float(p) for p in probs], 4.0 / ACCURACY
    if not columns:
        return df.sparkSession.createDataFrame([], "feature string, prob double, quantile double")
    found = []
    while columns:
        asked = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-slack, slack)})
        sketch = df.agg(*(F.percentile_approx(F.col(c).cast("double"), asked, ACCURACY).alias(f"c{i}")
                          for i, c in enumerate(columns))).first()
        spans = []
        for cuts in sketch:
            cut = dict(zip(asked, cuts or [], strict=False))
            spans.append(_disjoint([(cut[max(0.0, p - slack)] if p - slack > 0 else float("-inf"),
                                     cut[min(1.0, p + slack)] if p + slack < 1 else float("inf")) for p in probs]) if cut else [])
        lows, highs = ([[x[side] for x in of] for of in spans] for side in (0, 1))
        # A last bracket without an end takes in everything above, NaN too.
        place = count_reached(lows, lambda v, e: v >= e) + count_reached(
            [[x for x in of if x < float("inf")] for of in highs], lambda v, e: v > e)
        counts = (stacked(df, columns).withColumn("_place", place)
                  .withColumn("_at", F.when(F.col("_place") % 2 == 1, F.col("_v"))).groupBy("_i", "_place", "_at")
                  .agg(F.count(F.lit(1)).alias("_rows"))
                  .select(F.get(F.lit(columns), F.col("_i")).alias("feature"), "_place", "_at", F.col("_at").isNull().alias("_gap"), "_rows"))
        hits = _hits(running_totals(counts, [("_place", True), ("_at", True)], {"_n": F.col("_rows")}, ["feature"]), probs, ["feature"])
        columns = sorted(r[0] for r in hits.where("_gap").select("feature").distinct().collect()) if slack < 1.0 else []
        found.append(hits.where(~F.col("feature").isin(columns)) if columns else hits)
        slack *= 16
    return _interpolated(reduce(DataFrame.unionByName, found), ["feature"])


def stacked(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(_i, _v): number and value as double of every column of every row, NULLs left out."""
    cells = F.array(*[F.struct(F.lit(i).alias("_i"), F.col(c).cast("double").alias("_v")) for i, c in enumerate(columns)])
    return df.select(F.explode(cells).alias("c")).select("c.*").where("_v IS NOT NULL")


def count_reached(limits: list[list[float]], reached: Callable[[Column, Column], Column]) -> Column:
    """How many of its column's limits a stacked value reaches; the limits are literals."""
    own = F.get(F.lit(limits), F.col("_i")) if any(limits) else None
    return reduce(Column.__add__, [F.coalesce(reached(F.col("_v"), F.get(own, F.lit(j))).cast("int"), F.lit(0))
                                   for j in range(max(map(len, limits), default=0))], F.lit(0))


def _disjoint(spans: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Closed intervals in order, those that meet made one."""
    out: list[tuple[float, float]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _ranked_hits(rows: DataFrame, probs: list[float], groups: list[str], slack: float) -> DataFrame:
    """(groups, _at, _gap, h): the values, or gaps, that hold the ranks asked for.

    A few rows per group and quantile, written so that checking them costs nothing.
    """
    bracketed, low, high = _with_brackets(rows, probs, groups, slack)
    v = F.col("_v")
    inside = reduce(Column.__or__, [(v >= lo) & (v <= hi) for lo, hi in zip(low, high)])
    # A row between brackets is counted right after the highest bracket below it.
    below = [F.lit(float("-inf")), F.lit(float("-inf"))] + [F.when(hi < v, hi) for hi in high]
    counts = bracketed.select(
        *groups, F.when(inside, v).otherwise(F.greatest(*below)).alias("_at"), (~inside).alias("_gap"),
    ).groupBy(*groups, "_at", "_gap").agg(F.count(F.lit(1)).alias("_rows"))
    return _hits(running_totals(counts, [("_at", True), ("_gap", True)], {"_n": F.col("_rows")}, groups), probs, groups)


def _hits(ranked: DataFrame, probs: list[float], groups: list[str]) -> DataFrame:
    first, last = F.col("_n_cum") - F.col("_n"), F.col("_n_cum") - 1
    position = [(F.col("_n_total") - 1) * F.lit(p) for p in probs]
    hits = F.filter(
        F.array(*[
            F.struct(
                F.lit(p).alias("prob"),
                F.floor(pos).between(first, last).alias("is_low"),
                F.ceil(pos).between(first, last).alias("is_high"),
                (pos - F.floor(pos)).alias("weight"),
            )
            for p, pos in zip(probs, position)
        ]),
        lambda h: h["is_low"] | h["is_high"],
    )
    return materialise(ranked.select(*groups, "_at", "_gap", F.explode(hits).alias("h")), "hits")


def _with_brackets(rows: DataFrame, probs: list[float], groups: list[str],
                   slack: float) -> tuple[DataFrame, list[Column], list[Column]]:
    """Rows with a lower and an upper bound column per quantile, ``slack`` of all ranks apart from it.

    The approximate ranks are off by about ``1 / ACCURACY`` of the rows; the first
    slack of four times that keeps at least three rows more than needed. In a group of few
    rows a rank may fall outside; the caller then widens. The bounds are written first: one short row per
    group, whose known size lets Spark broadcast it when it is small.
    """
    asked = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-slack, slack)})
    cuts = materialise(
        rows.groupBy(*groups).agg(
            F.struct(F.percentile_approx("_v", asked, ACCURACY).alias("at")).alias("_cuts")), "brackets")

    def cut(p: float, outer: float) -> Column:
        if not 0.0 < p < 1.0:
            return F.lit(outer)
        return F.get("_cuts.at", asked.index(p))

    low = [cut(max(0.0, p - slack), float("-inf")) for p in probs]
    high = [cut(min(1.0, p + slack), float("inf")) for p in probs]
    if groups:
        return join_groups(rows, cuts, groups), low, high
    return rows.withColumn("_cuts", cuts.scalar()), low, high
