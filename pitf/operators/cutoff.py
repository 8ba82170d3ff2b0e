"""Adaptive cutoff: roll forward to the newest month whose label is still healthy."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitf.functions.scalars import between_inclusive, ratio
from pitf.functions.timeutil import as_date, date_text, month_sequence, month_start
from pitf.operators.sweep import population_at_cutoffs

ABSOLUTE, RELATIVE = "absolute_inactivity", "relative_inactivity"


@dataclass(frozen=True)
class LabelPolicy:
    """The default label and the health rules of a rolled one."""

    cutoff_date: str = "2025-03-01"
    window_days: int = 90
    definition: str = ABSOLUTE
    min_prior_txns: int = 1
    inactive_percentile: float = 0.10
    enabled: bool = True
    base_rate_min: float = 0.05
    base_rate_max: float = 0.40
    min_eligible: int = 1000
    max_lookback_months: int = 12


def _decision(policy: LabelPolicy, *, cutoff: Column, shifted: Column, reason: Column,
              base_rate: Column, eligible: Column) -> list[Column]:
    rolled = F.coalesce(shifted, F.lit(False))
    return [
        cutoff.alias("cutoff"),
        F.lit(policy.window_days).alias("window_days"),
        F.when(rolled, RELATIVE).otherwise(policy.definition).alias("definition"),
        F.when(rolled, F.lit(policy.inactive_percentile)).alias("inactive_percentile"),
        rolled.alias("shifted"),
        reason.alias("reason"),
        base_rate.cast("double").alias("base_rate"),
        eligible.cast("bigint").alias("eligible"),
    ]


def fixed_decision(transactions: DataFrame, policy: LabelPolicy, cutoff, reason: str) -> DataFrame:
    """Decision row for a cutoff nobody probed."""
    row = transactions.sparkSession.range(1)
    return row.select(*_decision(
        policy, cutoff=F.lit(str(cutoff)), shifted=F.lit(False), reason=F.lit(reason),
        base_rate=F.lit(float("nan")), eligible=F.lit(-1)))


def manual_decision(transactions: DataFrame, policy: LabelPolicy, cutoff) -> DataFrame:
    """Explicit override; the percentile applies only under a relative definition."""
    row = fixed_decision(transactions, policy, cutoff, "manual")
    return row.withColumn("inactive_percentile", F.lit(policy.inactive_percentile))


def ladder(transactions: DataFrame, policy: LabelPolicy, execution_date=None) -> DataFrame:
    """(candidate, cutoff, is_default): the default cutoff and every month from the
    newest observable one back, as far as the policy looks."""
    default = F.lit(as_date(policy.cutoff_date))
    run = as_date(execution_date)
    newest = F.max("transaction_date").cast("date")
    anchor = F.when(newest.isNotNull(), F.least(newest, F.lit(run))) if run else newest
    span = transactions.agg(month_start(F.date_sub(anchor, policy.window_days)).alias("candidate"))
    oldest = F.greatest(F.add_months("candidate", 1 - policy.max_lookback_months),
                        F.add_months(month_start(default), 1))
    rungs = F.coalesce(month_sequence(oldest, F.col("candidate")), F.array().cast("array<date>"))
    return (span.where("candidate IS NOT NULL")
            .select("candidate", F.explode(F.array_union(F.array(default), rungs)).alias("cutoff"))
            .withColumn("is_default", F.col("cutoff") == default))


def label_health(transactions: DataFrame, policy: LabelPolicy, execution_date=None) -> DataFrame:
    """Ladder with (base_rate, eligible, healthy) at every rung, all rungs in one job."""
    rungs = ladder(transactions, policy, execution_date)
    at = population_at_cutoffs(transactions, rungs, [policy.window_days], policy.min_prior_txns,
                               [as_date(policy.cutoff_date)])
    eligible = F.col("eligible")
    rate = F.coalesce(ratio(eligible - F.col(f"retained_{policy.window_days}"), eligible), F.lit(0.0))
    healthy = (eligible >= policy.min_eligible) & between_inclusive(
        F.col("base_rate"), policy.base_rate_min, policy.base_rate_max)
    return (rungs.join(at, "cutoff").select("candidate", "cutoff", "is_default", eligible, rate.alias("base_rate"))
            .withColumn("healthy", healthy))


def resolve_cutoff(transactions: DataFrame, policy: LabelPolicy, execution_date=None) -> DataFrame:
    """One decision row: the newest healthy rung above the default, else the default."""
    if not policy.enabled:
        return fixed_decision(transactions, policy, policy.cutoff_date, "disabled")
    health = label_health(transactions, policy, execution_date)
    facts = F.struct("cutoff", "base_rate", "eligible")
    picked = health.agg(
        F.max("candidate").alias("candidate"),
        F.max(F.when(~F.col("is_default") & F.col("healthy"), facts)).alias("rolled"),
        F.max(F.when(F.col("is_default"), facts)).alias("held"),
    )
    default = F.lit(policy.cutoff_date)
    rolled, held, candidate = F.col("rolled"), F.col("held"), F.col("candidate")
    to = date_text(rolled["cutoff"])
    # What decided; the figures stand in their own columns.
    reason = (
        F.when(candidate.isNull(), "no_events")
        .when(rolled["cutoff"] == candidate, "newest_month")
        .when(rolled.isNotNull(), "older_month")
        .when(candidate <= F.lit(as_date(policy.cutoff_date)), "nothing_newer")
        .otherwise("none_healthy")
    )
    chosen = F.coalesce(rolled, held)
    return picked.select(*_decision(
        policy, cutoff=F.coalesce(to, default), shifted=rolled.isNotNull(), reason=reason,
        base_rate=F.coalesce(chosen["base_rate"], F.lit(float("nan"))),
        eligible=F.coalesce(chosen["eligible"], F.lit(-1))))

