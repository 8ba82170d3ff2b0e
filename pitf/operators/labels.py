"""Inactivity label: who with past activity has none in the forward window."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitf.functions.timeutil import label_bounds
from pitf.operators.quantiles import discrete_quantile


def activity_counts(transactions: DataFrame, cutoff, window_days: int) -> DataFrame:
    """(customer_id, prior_txns, forward_txns) in one aggregation: counts in
    (-inf, cutoff) and in [cutoff, cutoff + window)."""
    start, end = label_bounds(cutoff, window_days)
    ts = F.col("transaction_date")
    return (transactions.where(ts < end)
            .groupBy("customer_id")
            .agg(F.count_if(ts < start).alias("prior_txns"), F.count_if(ts >= start).alias("forward_txns")))


def inactivity_threshold(population: DataFrame, percentile: float) -> DataFrame:
    """One row ``value``: the forward count at the given percentile of the population."""
    return discrete_quantile(population, F.col("forward_txns"), percentile)


def churn_flag(population: DataFrame, inactive_percentile: float | None = None) -> Column:
    """No forward activity, or with a percentile: at most as much as the least active share."""
    forward = F.col("forward_txns")
    if inactive_percentile is None:
        return (forward == 0).cast("int")
    return (forward <= inactivity_threshold(population, inactive_percentile).scalar()).cast("int")


def build_labels(transactions: DataFrame, cutoff, window_days: int, min_prior_txns: int = 1,
                 inactive_percentile: float | None = None) -> DataFrame:
    """(customer_id, churn) for every customer with enough transactions before the cutoff."""
    population = (activity_counts(transactions, cutoff, window_days)
                  .where(F.col("prior_txns") >= F.lit(min_prior_txns)))
    return population.select("customer_id", churn_flag(population, inactive_percentile).alias("churn"))
