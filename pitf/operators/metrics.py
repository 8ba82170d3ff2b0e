"""Classifier metrics over scored rows (customer_id, churn, churn_score), exact and distributed."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitf.functions.scalars import churn_call
from pitf.operators.prefix import join_groups, running_totals

TOP_FRACTION = 0.10


def rank_scores(scored: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Rows with their running count and running positives from the highest score
    down; equal scores are ordered by id, highest first."""
    rows = scored.select(*groups, "customer_id", "churn", "churn_score")
    return running_totals(rows, [("churn_score", False), ("customer_id", False)],
                          {"n": F.lit(1), "pos": F.col("churn").cast("bigint")}, groups)


def _top_count(top_fraction: float) -> Column:
    return F.greatest(F.lit(1), F.floor(F.col("n_total") * F.lit(top_fraction)))


def score_curve(ranked: DataFrame, groups: Sequence[str] = (), top_fraction: float = TOP_FRACTION) -> DataFrame:
    """One row per distinct score: its rows and positives, and those at or above it."""
    in_top = F.col("n_cum") <= _top_count(top_fraction)
    return ranked.groupBy(*groups, "churn_score").agg(
        F.sum("n").alias("rows"), F.sum("pos").alias("positives"),
        F.max("n_cum").alias("rows_above"), F.max("pos_cum").alias("positives_above"),
        F.max("n_total").alias("n_total"), F.max("pos_total").alias("pos_total"),
        F.sum(F.when(in_top, F.col("pos")).otherwise(0)).alias("top_positives"),
    )


def ranking_metrics(scored: DataFrame, groups: Sequence[str] = (), top_fraction: float = TOP_FRACTION) -> DataFrame:
    """Per group: ROC-AUC (ties count half), average precision (stepwise), lift
    over the base rate and precision in the top fraction.

    A group with one class gets AUC and average precision 0, a group without
    positives gets lift 0.
    """
    return _ranking_metrics(rank_scores(scored, groups), groups, top_fraction)


def _ranking_metrics(ranked: DataFrame, groups: Sequence[str], top_fraction: float = TOP_FRACTION) -> DataFrame:
    curve = score_curve(ranked, groups, top_fraction)
    pos, rows = F.col("positives"), F.col("rows")
    # Every negative of a score loses to the positives above it and ties with those beside it.
    won = (rows - pos) * (F.col("positives_above") - pos / F.lit(2.0))
    step = pos * F.col("positives_above") / F.col("rows_above")
    sums = curve.groupBy(*groups).agg(
        F.sum(won).alias("won"), F.sum(step).alias("steps"),
        F.max("n_total").alias("n_total"), F.max("pos_total").alias("pos_total"),
        F.sum("top_positives").alias("top_positives"))
    p, n = F.col("pos_total"), F.col("n_total")
    two_class = (p > 0) & (p < n)
    base = p / n
    ap = F.when(two_class, F.col("steps") / p).otherwise(0.0)
    return sums.select(
        *groups, n.alias("rows"), p.alias("positives"), base.alias("base_rate"),
        F.when(two_class, F.col("won") / (p.cast("double") * (n - p))).otherwise(0.0).alias("roc_auc"),
        ap.alias("average_precision"),
        F.when(p > 0, ap / base).otherwise(0.0).alias("ap_lift_over_base"),
        (F.col("top_positives") / _top_count(top_fraction)).alias("precision_at_decile"),
    )


def confusion_metrics(scored: DataFrame, groups: Sequence[str] = (), threshold: float = 0.5) -> DataFrame:
    """Per group: precision, recall and accuracy of ``score >= threshold``."""
    called, actual = churn_call(F.col("churn_score"), threshold) == 1, F.col("churn") == 1
    counts = scored.groupBy(*groups).agg(
        F.count_if(called & actual).alias("tp"), F.count_if(called).alias("called"),
        F.count_if(actual).alias("actual"), F.count_if(called == actual).alias("right"),
        F.count(F.lit(1)).alias("n"))
    return counts.select(
        *groups,
        (F.col("tp") / F.greatest(F.lit(1), "called")).alias("precision"),
        (F.col("tp") / F.greatest(F.lit(1), "actual")).alias("recall"),
        F.try_divide("right", "n").alias("accuracy"),
    )


def classifier_metrics(scored: DataFrame, groups: Sequence[str]) -> DataFrame:
    """All seven metrics per group (one row per candidate model); scores are computed once."""
    ranked = rank_scores(scored, groups)
    return join_groups(_ranking_metrics(ranked, groups), confusion_metrics(ranked, groups), groups)
