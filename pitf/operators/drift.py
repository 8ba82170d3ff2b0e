"""Population stability index of a score or feature against a baseline."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitf.operators.prefix import join_groups
from pitf.operators.quantiles import column_quantiles, count_reached, exact_quantiles, stacked

# Bins, least bin share, alarm threshold and severity bands.
BINS = 10
FLOOR = 1e-6
THRESHOLD = 0.25
MODERATE = 0.10


def bin_edges(baseline: DataFrame, value: str, bins: int = BINS, groups: Sequence[str] = ()) -> DataFrame:
    """(groups, edges, inner): distinct interpolated quantiles of the baseline,
    ascending, and the same without the outermost two."""
    probs = [i / bins for i in range(bins + 1)]
    quantiles = exact_quantiles(baseline, value, probs, groups)
    edges = quantiles.groupBy(*groups).agg(F.sort_array(F.collect_set("quantile")).alias("edges"))
    return edges.withColumn("inner", F.slice("edges", 2, F.greatest(F.size("edges") - 2, F.lit(0))))


def bin_index(value: Column, inner: Column, bins: int = BINS) -> Column:
    """Number of inner edges at or below the value; the outer bins are open-ended."""
    return reduce(lambda a, b: a + b, [
        F.coalesce((value >= F.get(inner, i)).cast("int"), F.lit(0)) for i in range(bins - 1)
    ])


def histogram(df: DataFrame, value: str, edges: DataFrame, bins: int = BINS,
              groups: Sequence[str] = ()) -> DataFrame:
    """(groups, bin, rows) of the non-NULL values."""
    rows = _with_edges(df.where(F.col(value).isNotNull()), edges, groups)
    return rows.groupBy(*groups, bin_index(F.col(value), F.col("inner"), bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("rows"))


def _with_edges(df: DataFrame, edges: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Attach the edges: a scalar subquery for one distribution, else a join on the group."""
    if groups:
        return join_groups(df, edges, groups)
    return df.withColumn("_e", edges.select(F.struct("edges", "inner")).scalar()).select("*", "_e.*").drop("_e")


def psi(baseline: DataFrame, current: DataFrame, value: str, bins: int = BINS,
        groups: Sequence[str] = ()) -> DataFrame:
    """(groups, psi, severity). Fewer than two edges (a constant baseline) give 0."""
    return _psi(baseline, current, value, bin_edges(baseline, value, bins, groups), bins, list(groups))


def _psi(baseline: DataFrame, current: DataFrame, value: str, edges: DataFrame, bins: int,
         groups: list[str]) -> DataFrame:
    sides = [df.select(*groups, F.col(value).cast("double").alias("value"), F.lit(side).alias("is_current"))
             for side, df in ((False, baseline), (True, current))]
    both = _with_edges(reduce(DataFrame.unionByName, sides).where("value IS NOT NULL"), edges, groups)
    counted = both.groupBy(*groups, bin_index(F.col("value"), F.col("inner"), bins).alias("bin")).agg(
        F.count_if(~F.col("is_current")).alias("expected"), F.count_if("is_current").alias("actual"),
        F.max(F.size("edges")).alias("edge_count"))
    return _from_counts(counted, groups)


def _from_counts(counted: DataFrame, groups: list[str]) -> DataFrame:
    """The index from (groups, bin, expected, actual, edge_count), at most one row per group and bin."""
    shares = counted.groupBy(*groups).agg(
        F.sum("expected").alias("e_total"), F.sum("actual").alias("a_total"),
        F.max("edge_count").alias("edge_count"),
        F.collect_list(F.struct("expected", "actual")).alias("cells"))
    e_total, a_total = F.col("e_total"), F.col("a_total")

    def term(cell: Column) -> Column:
        e = F.greatest(F.try_divide(cell["expected"].cast("double"), e_total), F.lit(FLOOR))
        a = F.greatest(F.try_divide(cell["actual"].cast("double"), a_total), F.lit(FLOOR))
        return (a - e) * F.log(a / e)

    # A bin empty on both sides has both shares at the floor and contributes nothing.
    total = F.aggregate(F.transform("cells", term), F.lit(0.0), lambda acc, t: acc + t)
    value_col = F.when(F.col("edge_count") < 2, F.lit(0.0)).otherwise(total)
    return shares.select(*groups, value_col.alias("psi")).withColumn("severity", severity(F.col("psi")))


def severity(psi_value: Column) -> Column:
    return (F.when(psi_value < MODERATE, "stable").when(psi_value <= THRESHOLD, "moderate")
            .otherwise("significant"))


def drift_decision(psi_row: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Adds the token: ``breach`` strictly above the threshold, else ``ok``."""
    return psi_row.withColumn("threshold", F.lit(threshold)).withColumn(
        "decision", F.when(F.col("psi") > threshold, "breach").otherwise("ok"))


def feature_psi(baseline: DataFrame, current: DataFrame, features: Sequence[str], bins: int = BINS) -> DataFrame:
    """(feature, psi, severity) of every feature; all features share each pass over the two snapshots.

    Edges are exact quantiles of the baseline, at most ``bins + 1`` per feature, and become literals. Each row turns into an
    array of bin numbers, counted by task, so only one row per feature and bin is shuffled.
    """
    quantiles = column_quantiles(baseline, features, [i / bins for i in range(bins + 1)])
    edges = {r[0]: r[1] for r in quantiles.groupBy("feature").agg(F.sort_array(F.collect_set("quantile"))).collect()}
    names = [f for f in features if f in edges]
    if not names:
        return baseline.sparkSession.createDataFrame([], "feature string, psi double, severity string")
    place = count_reached([edges[f][1:-1] for f in names], lambda v, e: v >= e)
    both = reduce(DataFrame.unionByName, [stacked(df, names).select("_i", place.alias("bin"), F.lit(side).alias("is_current"))
                                          for side, df in ((False, baseline), (True, current))])
    counted = both.groupBy("_i", "bin").agg(F.count_if(~F.col("is_current")).alias("expected"), F.count_if("is_current").alias("actual"))
    return _from_counts(counted.select(F.get(F.lit(names), F.col("_i")).alias("feature"), "bin", "expected", "actual",
                                       F.get(F.lit([len(edges[f]) for f in names]), F.col("_i")).alias("edge_count")), ["feature"])
