"""Label health over a grid of cutoffs and windows, and the choice between them.

The sweep never compares events with cutoffs pairwise. Cutoffs are month starts
(plus a few named dates), so only the first event and the number of events of a
customer between two cutoffs matter. Each such step changes the running counts
at a known place on the grid; the changes are summed per grid step and
accumulated over the grid, which has as many rows as the calendar has months.
"""
from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitf.functions.scalars import between_inclusive, change_rate, ratio
from pitf.functions.timeutil import days_earlier, elapsed_days, month_sequence, month_start
from pitf.operators.quantiles import exact_quantiles
from pitf.session import materialise

# Label windows compared, usable churn band, least population.
WINDOWS = (30, 60, 90)
CHURN_BAND = (0.05, 0.40)
MIN_ELIGIBLE = 1000
# Months of history before the first candidate cutoff.
WARM_UP_MONTHS = 3


def monthly_activity_profile(transactions: DataFrame) -> DataFrame:
    """Per month: volume, active customers, amount and balance statistics, growth."""
    tx = transactions.withColumn("month", month_start(F.col("transaction_date"))).where("month IS NOT NULL")
    totals = tx.groupBy("month").agg(
        F.count("transaction_id").alias("transactions"),
        F.count_distinct("customer_id").alias("active_users"),
        F.sum("transaction_amount").alias("total_amount"),
        F.avg("transaction_amount").alias("avg_amount"),
        F.avg("closing_balance").alias("avg_closing_balance"),
    )
    named = tx.select("month", F.col("transaction_amount").alias("median_amount"),
                      F.col("closing_balance").alias("median_closing_balance"))
    measures = ["median_amount", "median_closing_balance"]
    medians = (exact_quantiles(named.unpivot("month", measures, "measure", "amount"), "amount", [0.5],
                               ["month", "measure"])
               .groupBy("month").pivot("measure", measures).agg(F.first("quantile")))
    by_month = Window.orderBy("month")
    return totals.join(medians, "month", "left").select(
        "*",
        ratio(F.col("transactions"), F.col("active_users")).alias("txn_per_active_user"),
        change_rate(F.col("transactions"), F.lag("transactions").over(by_month)).alias("transaction_growth_pct"),
        change_rate(F.col("active_users"), F.lag("active_users").over(by_month)).alias("active_user_growth_pct"),
    )


def candidate_cutoffs(transactions: DataFrame) -> DataFrame:
    """(cutoff, data_end): month starts from three months after the first event's month."""
    span = transactions.agg(F.min("transaction_date").alias("lo"), F.max("transaction_date").alias("hi"))
    grid = month_sequence(F.add_months(month_start(F.col("lo")), WARM_UP_MONTHS), month_start(F.col("hi")))
    return span.select(F.explode(grid).alias("cutoff"), F.col("hi").alias("data_end"))


def _step_start(ts: Column, named: Sequence[date]) -> Column:
    """Latest possible cutoff at or before ``ts``."""
    return F.greatest(month_start(ts), *[F.when(ts >= F.lit(d), F.lit(d)) for d in named]) if named \
        else month_start(ts)


def _next_cutoff(ts: Column, named: Sequence[date]) -> Column:
    """First possible cutoff after ``ts``: from there on the event is in the past."""
    month = F.add_months(month_start(ts), 1)
    return F.least(month, *[F.when(ts < F.lit(d), F.lit(d)) for d in named]) if named else month


def customer_steps(transactions: DataFrame, grid: DataFrame, named: Sequence[date] = ()) -> DataFrame:
    """One row per customer and grid step with activity: events in the step, first
    event, events before it, and the previous active step.

    Everything before the first cutoff of the grid is one step. The aggregation by
    (customer, step) comes first, so the window that follows sees at most one row
    per calendar month of a customer, however busy.
    """
    first = grid.agg(F.min("cutoff").alias("first")).scalar()
    step = F.greatest(_step_start(F.col("transaction_date"), named), month_start(F.date_sub(first, 1)))
    steps = (transactions.where("transaction_date IS NOT NULL")
             .groupBy("customer_id", step.alias("step"))
             .agg(F.count(F.lit(1)).alias("events"), F.min("transaction_date").alias("first_event")))
    history = Window.partitionBy("customer_id").orderBy("step")
    seen = F.sum("events").over(history.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return steps.select("*", F.lag("step").over(history).alias("previous_step"),
                        (seen - F.col("events")).alias("seen_before"))


def _accumulate(changes: DataFrame, grid: DataFrame) -> DataFrame:
    """Running sum of the changes, read at every cutoff of the grid.

    Changes arrive summed per cutoff, so what is ordered here is bounded by the
    number of calendar months.
    """
    measures = [c for c in changes.columns if c != "cutoff"]
    zero = grid.select("cutoff", *[F.lit(0).cast("bigint").alias(m) for m in measures], F.lit(True).alias("_asked"))
    both = changes.withColumn("_asked", F.lit(False)).unionByName(zero)
    summed = both.groupBy("cutoff").agg(*[F.sum(m).alias(m) for m in measures], F.bool_or("_asked").alias("_asked"))
    upto = Window.orderBy("cutoff").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (summed.select("cutoff", "_asked", *[F.sum(m).over(upto).alias(m) for m in measures])
            .where("_asked").drop("_asked"))


def population_changes(steps: DataFrame, windows: Sequence[int], min_prior_txns: int = 1,
                       named: Sequence[date] = ()) -> DataFrame:
    """Changes of the population counts, summed per cutoff.

    - ``eligible``: customers with enough events before the cutoff
    - ``prior_rows``: events before the cutoff
    - ``active_W``: customers with an event in [cutoff, cutoff + W)
    - ``retained_W``: those of them that were eligible
    """
    k = F.lit(min_prior_txns)
    was_eligible = F.col("seen_before") >= k
    becomes_eligible = ~was_eligible & (F.col("seen_before") + F.col("events") >= k)
    here = _next_cutoff(F.col("step"), named)
    zero = F.lit(0).cast("bigint")

    def entry(at: Column, values: dict[str, Column]) -> Column:
        names = ["eligible", "prior_rows", *[f"{p}_{w}" for w in windows for p in ("active", "retained")]]
        return F.struct(at.alias("cutoff"), *[values.get(n, zero).cast("bigint").alias(n) for n in names])

    # The step's first event leaves every forward window once the cutoff has passed the step ...
    leaving = {f"active_{w}": F.lit(-1) for w in windows}
    leaving |= {f"retained_{w}": -was_eligible.cast("int") for w in windows}
    entries = [entry(here, leaving | {"eligible": becomes_eligible.cast("int"), "prior_rows": F.col("events")})]
    # ... and is the next event for cutoffs after the previous step, visible from W days before it.
    for w in windows:
        visible = F.greatest(F.col("previous_step").cast("timestamp"), days_earlier(F.col("first_event"), w))
        entries.append(entry(_next_cutoff(visible, named),
                             {f"active_{w}": F.lit(1), f"retained_{w}": was_eligible.cast("int")}))

    changes = steps.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    return changes.groupBy("cutoff").agg(*[F.sum(c).alias(c) for c in changes.columns if c != "cutoff"])


def population_at_cutoffs(transactions: DataFrame, grid: DataFrame, windows: Sequence[int] = WINDOWS,
                          min_prior_txns: int = 1, named: Sequence[date] = ()) -> DataFrame:
    """(cutoff, eligible, prior_rows, active_W.., retained_W..) for every cutoff of the grid.

    Events after the last window are not read further.
    """
    last = grid.agg(F.max("cutoff").alias("last")).scalar()
    seen = transactions.where(F.col("transaction_date") < F.date_add(last, max(windows)).cast("timestamp"))
    return _accumulate(population_changes(customer_steps(seen, grid, named), windows, min_prior_txns, named), grid)


def signups_at_cutoffs(customers: DataFrame, grid: DataFrame) -> DataFrame:
    """(cutoff, signed_up_customers): distinct customers that signed up before each cutoff."""
    first = (customers.where("signup_date IS NOT NULL").groupBy("customer_id")
             .agg(F.min("signup_date").alias("signup")))
    changes = (first.groupBy(_next_cutoff(F.col("signup"), ()).alias("cutoff"))
               .agg(F.count(F.lit(1)).alias("signed_up_customers")))
    return _accumulate(changes, grid)


def median_prior_events(transactions: DataFrame, grid: DataFrame) -> DataFrame:
    """(cutoff, median_prior_txn_per_customer) over customers with a prior event."""
    return median_of_steps(customer_steps(transactions, grid), grid)


def median_of_steps(steps: DataFrame, grid: DataFrame) -> DataFrame:
    """``median_prior_events`` from the steps of the customers.

    Keeps, per cutoff, how many customers have each event count. N events allow
    fewer than sqrt(2N) distinct counts, which bounds what one median holds.
    """
    here = _next_cutoff(F.col("step"), ())
    moves = steps.select(F.explode(F.array(
        F.struct(here.alias("since"), (F.col("seen_before") + F.col("events")).alias("seen"), F.lit(1).alias("moved")),
        F.struct(here.alias("since"), F.col("seen_before").alias("seen"), F.lit(-1).alias("moved")),
    )).alias("m")).select("m.*").where("seen > 0")
    moves = moves.groupBy("seen", "since").agg(F.sum("moved").alias("moved"))
    by_count = Window.partitionBy("seen").orderBy("since")
    bounds = grid.agg(F.struct(F.min("cutoff").alias("lo"), F.max("cutoff").alias("hi")).alias("bounds")).scalar()
    held = moves.select(
        "seen", "since",
        F.sum("moved").over(by_count.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("customers"),
        F.add_months(F.lead("since").over(by_count), -1).alias("until"), bounds.alias("bounds"),
    ).where("customers > 0")
    # Each count holds from one change to the month before the next.
    months = month_sequence(F.greatest("since", "bounds.lo"), F.least("until", "bounds.hi"))
    spread = held.select("seen", "customers", F.explode(months).alias("cutoff"))
    return spread.groupBy("cutoff").agg(
        F.percentile("seen", 0.5, F.col("customers")).alias("median_prior_txn_per_customer"))


def cutoff_feasibility(customers: DataFrame, transactions: DataFrame, windows: Sequence[int] = WINDOWS) -> DataFrame:
    """Per candidate cutoff: population, history depth, future activity and room for each window.

    The grid and the steps are written once, so the events are read twice (span, steps) and shuffled once, already counted
    by customer and step; population and medians both sweep the stored steps, at most one row per customer and month.
    """
    grid = materialise(candidate_cutoffs(transactions), "cutoffs")
    steps = materialise(customer_steps(transactions, grid), "steps")
    facts = reduce(lambda a, b: a.join(b, "cutoff", "left"), [
        grid,
        _accumulate(population_changes(steps, windows), grid),
        signups_at_cutoffs(customers, grid),
        median_of_steps(steps, grid),
    ])
    cut = F.col("cutoff").cast("timestamp")
    signed_up, eligible = F.col("signed_up_customers"), F.col("eligible")
    return facts.select(
        "cutoff", "signed_up_customers",
        eligible.alias("eligible_customers"),
        (signed_up - eligible).alias("no_prior_txn_customers"),
        F.col("prior_rows").alias("prior_txn_rows"),
        ratio(F.col("prior_rows"), eligible).alias("prior_txn_per_customer"),
        "median_prior_txn_per_customer",
        *[F.col(f"active_{w}").alias(f"future_{w}d_txn_customers") for w in windows],
        elapsed_days(F.col("data_end"), cut).alias("days_until_txn_end"),
        *[window_fits(w).alias(f"full_{w}d_window") for w in windows],
        ratio(eligible, signed_up).alias("eligible_pct_of_signed_up"),
        ratio(signed_up - eligible, signed_up).alias("no_prior_txn_pct_of_signed_up"),
    )


def window_fits(days: int | Column) -> Column:
    """The whole window lies inside the observed data."""
    return F.date_add("cutoff", days).cast("timestamp") <= F.col("data_end")


def label_sweep(transactions: DataFrame, windows: Sequence[int] = WINDOWS) -> DataFrame:
    """One row per candidate cutoff and window: population, churned, churn rate, fit."""
    grid = candidate_cutoffs(transactions)
    wide = population_at_cutoffs(transactions, grid, windows).join(grid, "cutoff")
    per_window = F.explode(F.array(*[
        F.struct(F.lit(w).alias("label_window_days"), F.col(f"retained_{w}").alias("retained")) for w in windows
    ])).alias("w")
    long = wide.select("cutoff", "data_end", F.col("eligible").alias("eligible_customers"), per_window).select(
        "*", "w.label_window_days", (F.col("eligible_customers") - F.col("w.retained")).alias("churned"))
    return long.select(
        "cutoff", "label_window_days",
        F.date_add("cutoff", F.col("label_window_days")).alias("label_end"),
        "eligible_customers", "churned",
        ratio(F.col("churned"), F.col("eligible_customers")).alias("churn_rate"),
        window_fits(F.col("label_window_days")).alias("label_window_fits"),
    )


def churn_rate_matrix(sweep: DataFrame, windows: Sequence[int] = WINDOWS) -> DataFrame:
    """Cutoff by window matrix of churn rates, columns ``churn_rate_W``."""
    matrix = sweep.groupBy("cutoff").pivot("label_window_days", list(windows)).agg(F.first("churn_rate"))
    return matrix.select("cutoff", *[F.col(str(w)).alias(f"churn_rate_{w}") for w in windows])


def label_stability(sweep: DataFrame, spike_start: date) -> DataFrame:
    """Adds the swing against the neighbouring cutoffs and the distance from a known spike."""
    along = Window.partitionBy("label_window_days").orderBy("cutoff")
    rate = F.col("churn_rate")
    return sweep.select(
        "*", F.lag("churn_rate").over(along).alias("previous_churn_rate"),
        F.lead("churn_rate").over(along).alias("next_churn_rate"),
    ).select(
        "*",
        F.abs(rate - F.col("previous_churn_rate")).alias("churn_rate_change_from_previous"),
        F.abs(F.col("next_churn_rate") - rate).alias("churn_rate_change_to_next"),
        F.abs(F.date_diff("cutoff", F.lit(spike_start))).alias("days_from_spike"),
    ).withColumn("local_churn_rate_instability",
                 F.greatest("churn_rate_change_from_previous", "churn_rate_change_to_next"))


def decision_table(stability: DataFrame, band: tuple[float, float] = CHURN_BAND,
                   min_eligible: int = MIN_ELIGIBLE) -> DataFrame:
    """Adds the pass flag; passing rows first, then longest window, then newest cutoff."""
    passes = (between_inclusive(F.col("churn_rate"), *band) & (F.col("eligible_customers") >= min_eligible)
              & F.col("label_window_fits"))
    return (stability.withColumn("passes_basic_label_rules", F.coalesce(passes, F.lit(False)))
            .orderBy(F.desc("passes_basic_label_rules"), F.desc("label_window_days"), F.desc("cutoff")))


def valid_candidates(decisions: DataFrame, spike_start: date | None = None) -> DataFrame:
    """Passing rows with their window end; with a spike, only those that end before it."""
    valid = (decisions.where("passes_basic_label_rules")
             .withColumn("window_end", F.date_add("cutoff", F.col("label_window_days"))))
    if spike_start is not None:
        valid = valid.where(F.col("window_end") <= F.lit(spike_start))
    return valid.orderBy(F.desc("label_window_days"), F.desc("cutoff"))


def choose_cutoff(decisions: DataFrame, spike_start: date) -> DataFrame:
    """The selected row: valid and spike-safe, longest window, then newest cutoff."""
    return valid_candidates(decisions, spike_start).limit(1)
