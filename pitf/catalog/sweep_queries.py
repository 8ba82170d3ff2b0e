"""Cutoff and window analysis, and the adaptive cutoff."""
from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from pitf.catalog.common import MONEY, as_bigint, as_text, feature_ctes, label_ctes, mean_sql, rounded, with_ctes
from pitf.catalog.feature_queries import FEATURE_LIST
from pitf.operators import cutoff as ct
from pitf.operators import sweep as sw
from pitf.plans import jobs
from pitf.sources import sample_tables as st
from pitf.sources.sample_tables import SAMPLE_LABEL

SPIKE = date(1998, 6, 1)
# 90 days are too short for the sample tables' order rhythm; longer windows reach the usable band.
LONG_WINDOWS = (180, 365)
SHORT = replace(SAMPLE_LABEL, window_days=90)
MID_MONTH = replace(SAMPLE_LABEL, cutoff_date="1998-03-17", min_prior_txns=2, base_rate_max=0.20)
HELD_RUN = "1999-02-15"


def monthly_activity_profile(spark: SparkSession, sf: str) -> DataFrame:
    money = {c: 3 for c in ("total_amount", "median_amount", "median_closing_balance")}
    return rounded(as_text(sw.monthly_activity_profile(st.transactions(spark, sf)), "month"), money=money)


def candidate_cutoffs(spark: SparkSession, sf: str) -> DataFrame:
    return as_text(sw.candidate_cutoffs(st.transactions(spark, sf)), "cutoff", "data_end")


def cutoff_feasibility(spark: SparkSession, sf: str) -> DataFrame:
    table = sw.cutoff_feasibility(st.customers(spark, sf), st.transactions(spark, sf))
    return rounded(as_text(as_bigint(table), "cutoff"))


def median_prior_events(spark: SparkSession, sf: str) -> DataFrame:
    tx = st.transactions(spark, sf)
    return as_text(sw.median_prior_events(tx, sw.candidate_cutoffs(tx)), "cutoff")


def _sweep(spark: SparkSession, sf: str, windows=sw.WINDOWS) -> DataFrame:
    return sw.label_sweep(st.transactions(spark, sf), windows)


def label_sweep(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(as_text(as_bigint(_sweep(spark, sf)), "cutoff", "label_end"))


def churn_rate_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(as_text(sw.churn_rate_matrix(_sweep(spark, sf)), "cutoff"))


def label_stability(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(as_text(as_bigint(sw.label_stability(_sweep(spark, sf), SPIKE)), "cutoff", "label_end"))


def _decisions(spark: SparkSession, sf: str) -> DataFrame:
    return sw.decision_table(sw.label_stability(_sweep(spark, sf, LONG_WINDOWS), SPIKE), min_eligible=100)


_DECISION_COLUMNS = ["cutoff", "label_window_days", "eligible_customers", "churn_rate", "label_window_fits",
                     "local_churn_rate_instability", "days_from_spike", "passes_basic_label_rules"]


def cutoff_decisions(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(as_text(as_bigint(_decisions(spark, sf).select(*_DECISION_COLUMNS)), "cutoff"))


def valid_cutoffs(spark: SparkSession, sf: str) -> DataFrame:
    valid = sw.valid_candidates(_decisions(spark, sf))
    return rounded(as_text(as_bigint(valid.select(*_DECISION_COLUMNS[:-1], "window_end")), "cutoff", "window_end"))


def chosen_cutoff(spark: SparkSession, sf: str) -> DataFrame:
    chosen = sw.choose_cutoff(_decisions(spark, sf), date(1999, 6, 1))
    return rounded(as_text(as_bigint(chosen.select("cutoff", "label_window_days", "eligible_customers", "churn_rate",
                                                   "window_end")), "cutoff", "window_end"))


def _health(spark: SparkSession, sf: str, policy: ct.LabelPolicy) -> DataFrame:
    return rounded(as_text(ct.label_health(st.transactions(spark, sf), policy), "candidate", "cutoff"))


def label_health(spark: SparkSession, sf: str) -> DataFrame:
    return _health(spark, sf, SAMPLE_LABEL)


def label_health_mid_month(spark: SparkSession, sf: str) -> DataFrame:
    return _health(spark, sf, MID_MONTH)


def _decide(spark: SparkSession, sf: str, policy: ct.LabelPolicy, execution_date=None) -> DataFrame:
    decision = as_bigint(ct.resolve_cutoff(st.transactions(spark, sf), policy, execution_date))
    return rounded(decision.fillna({"inactive_percentile": -1.0}))


def adaptive_cutoff(spark: SparkSession, sf: str) -> DataFrame:
    return _decide(spark, sf, SAMPLE_LABEL)


def adaptive_cutoff_short_window(spark: SparkSession, sf: str) -> DataFrame:
    return _decide(spark, sf, SHORT)


def adaptive_cutoff_mid_month(spark: SparkSession, sf: str) -> DataFrame:
    return _decide(spark, sf, MID_MONTH)


def adaptive_cutoff_held(spark: SparkSession, sf: str) -> DataFrame:
    return _decide(spark, sf, SAMPLE_LABEL, HELD_RUN)


def adaptive_feature_table(spark: SparkSession, sf: str) -> DataFrame:
    raw = st.raw_tables(spark, sf)
    decision = jobs.resolve_decision(raw, SAMPLE_LABEL).first()
    return rounded(as_bigint(jobs.build_feature_table(raw, decision)), money=MONEY)


SPAN = "SELECT min(transaction_date) AS lo, max(transaction_date) AS hi FROM transactions"
GRID = """SELECT CAST(c AS TIMESTAMP) AS cutoff, hi AS data_end FROM span,
    LATERAL (SELECT unnest(generate_series(date_trunc('month', lo) + INTERVAL 3 MONTH,
             date_trunc('month', hi), INTERVAL 1 MONTH)) AS c)"""


def sweep_ctes(windows) -> dict[str, str]:
    """Every cutoff against every event, window by window."""
    lengths = ", ".join(f"({w})" for w in windows)
    return {
        "span": SPAN,
        "grid": GRID,
        "lengths": f"SELECT col0 AS w FROM (VALUES {lengths})",
        "eligible_at": """SELECT DISTINCT cutoff, customer_id FROM grid JOIN transactions ON transaction_date < cutoff""",
        "active_at": """SELECT DISTINCT cutoff, w, customer_id FROM grid CROSS JOIN lengths JOIN transactions
            ON transaction_date >= cutoff AND transaction_date < cutoff + to_days(CAST(w AS INTEGER))""",
        "sweep_base": """SELECT cutoff, w AS label_window_days, count(*) AS eligible_customers,
            sum(CASE WHEN a.customer_id IS NULL THEN 1 ELSE 0 END) AS churned
            FROM eligible_at CROSS JOIN lengths LEFT JOIN active_at a USING (cutoff, w, customer_id)
            GROUP BY cutoff, w""",
        "sweep": """SELECT b.cutoff, CAST(label_window_days AS BIGINT) AS label_window_days,
            b.cutoff + to_days(CAST(label_window_days AS INTEGER)) AS label_end, eligible_customers,
            CAST(churned AS BIGINT) AS churned, churned / CAST(eligible_customers AS DOUBLE) AS churn_rate,
            b.cutoff + to_days(CAST(label_window_days AS INTEGER)) <= data_end AS label_window_fits
            FROM sweep_base b JOIN grid USING (cutoff)""",
        "neighbours": """SELECT *, lag(churn_rate) OVER p AS previous_churn_rate, lead(churn_rate) OVER p AS next_churn_rate
            FROM sweep WINDOW p AS (PARTITION BY label_window_days ORDER BY cutoff)""",
        "stability": f"""SELECT *, abs(churn_rate - previous_churn_rate) AS churn_rate_change_from_previous,
            abs(next_churn_rate - churn_rate) AS churn_rate_change_to_next,
            CAST(abs(date_diff('day', CAST(cutoff AS DATE), DATE '{SPIKE}')) AS BIGINT) AS days_from_spike,
            greatest(abs(churn_rate - previous_churn_rate), abs(next_churn_rate - churn_rate))
                AS local_churn_rate_instability FROM neighbours""",
        "decisions": """SELECT *, coalesce(churn_rate BETWEEN 0.05 AND 0.40 AND eligible_customers >= 100
            AND label_window_fits, false) AS passes_basic_label_rules,
            cutoff + to_days(CAST(label_window_days AS INTEGER)) AS window_end FROM stability""",
    }


def day(name: str) -> str:
    return f"strftime({name}, '%Y-%m-%d') AS {name}"


SWEEP, LONG_SWEEP = sweep_ctes(sw.WINDOWS), sweep_ctes(LONG_WINDOWS)


def decision_ctes(policy: ct.LabelPolicy, execution_date: str | None = None) -> dict[str, str]:
    """The ladder rule by direct probing of every rung."""
    default, w = f"DATE '{policy.cutoff_date}'", policy.window_days
    run = f"least(CAST(max(transaction_date) AS DATE), DATE '{execution_date}')" if execution_date \
        else "CAST(max(transaction_date) AS DATE)"
    return {
        "anchor": f"SELECT CAST(date_trunc('month', {run} - {w}) AS DATE) AS candidate FROM transactions",
        "steps": f"SELECT unnest(generate_series(0, {policy.max_lookback_months - 1})) AS i",
        "rungs": f"""SELECT candidate, CAST(candidate - to_months(CAST(i AS INTEGER)) AS DATE) AS cutoff, false AS is_default
            FROM anchor CROSS JOIN steps WHERE CAST(candidate - to_months(CAST(i AS INTEGER)) AS DATE) > {default}
            UNION ALL SELECT candidate, {default}, true FROM anchor""",
        "rung_prior": f"""SELECT cutoff, customer_id FROM rungs JOIN transactions ON transaction_date < cutoff
            GROUP BY 1, 2 HAVING count(*) >= {policy.min_prior_txns}""",
        "rung_active": f"""SELECT DISTINCT cutoff, customer_id FROM rungs JOIN transactions
            ON transaction_date >= cutoff AND transaction_date < cutoff + INTERVAL {w} DAY""",
        "rung_counts": """SELECT cutoff, count(*) AS eligible,
            avg(CASE WHEN a.customer_id IS NULL THEN 1.0::DOUBLE ELSE 0 END) AS base_rate
            FROM rung_prior LEFT JOIN rung_active a USING (cutoff, customer_id) GROUP BY cutoff""",
        "health": f"""SELECT candidate, cutoff, is_default, coalesce(eligible, 0) AS eligible,
            coalesce(base_rate, 0) AS base_rate,
            coalesce(eligible, 0) >= {policy.min_eligible} AND coalesce(base_rate, 0)
                BETWEEN {policy.base_rate_min} AND {policy.base_rate_max} AS healthy
            FROM rungs LEFT JOIN rung_counts USING (cutoff)""",
        "chosen": """SELECT * FROM health WHERE is_default OR healthy ORDER BY is_default, cutoff DESC LIMIT 1""",
        "decision": f"""SELECT strftime(cutoff, '%Y-%m-%d') AS cutoff, CAST({w} AS BIGINT) AS window_days,
            CASE WHEN is_default THEN '{policy.definition}' ELSE 'relative_inactivity' END AS definition,
            CASE WHEN is_default THEN -1.0::DOUBLE ELSE {policy.inactive_percentile}::DOUBLE END AS inactive_percentile,
            NOT is_default AS shifted,
            CASE WHEN NOT is_default AND cutoff = candidate THEN 'newest_month' WHEN NOT is_default THEN 'older_month'
            WHEN candidate <= {default} THEN 'nothing_newer' ELSE 'none_healthy' END AS reason,
            round(base_rate, 6) AS base_rate, eligible FROM chosen""",
    }


def _health_sql(policy: ct.LabelPolicy) -> str:
    return with_ctes(f"""SELECT {day('candidate')}, {day('cutoff')}, is_default, eligible,
        round(base_rate, 6) AS base_rate, healthy FROM health""", **decision_ctes(policy))


def _decision_sql(policy: ct.LabelPolicy, execution_date: str | None = None) -> str:
    return with_ctes("SELECT * FROM decision", **decision_ctes(policy, execution_date))


_ROLLED_CUT = "(SELECT CAST(cutoff AS TIMESTAMP) FROM decision)"
_FUTURE = ", ".join(f"""(SELECT count(DISTINCT customer_id) FROM transactions WHERE transaction_date >= cutoff
    AND transaction_date < cutoff + INTERVAL {w} DAY) AS future_{w}d_txn_customers""" for w in sw.WINDOWS)
_FULL = ", ".join(f"cutoff + INTERVAL {w} DAY <= data_end AS full_{w}d_window" for w in sw.WINDOWS)
_PRIOR_CTES = {
    "span": SPAN,
    "grid": GRID,
    "prior_counts": """SELECT cutoff, customer_id, count(*) AS n FROM grid JOIN transactions
        ON transaction_date < cutoff GROUP BY cutoff, customer_id""",
    "prior": """SELECT cutoff, count(*) AS eligible_customers, CAST(sum(n) AS BIGINT) AS prior_txn_rows,
        sum(n) / CAST(count(*) AS DOUBLE) AS prior_txn_per_customer, median(n) AS median_prior_txn_per_customer
        FROM prior_counts GROUP BY cutoff""",
    "windows_at": f"""SELECT cutoff, data_end, {_FULL}, {_FUTURE},
        (SELECT count(DISTINCT customer_id) FROM customers WHERE signup_date < cutoff) AS signed_up_customers,
        {"CAST(floor((epoch(data_end) - epoch(cutoff)) / 86400) AS BIGINT)"} AS days_until_txn_end FROM grid""",
}

QUERIES = {
    "monthly_activity_profile": (monthly_activity_profile, with_ctes(
        f"""SELECT strftime(month, '%Y-%m-%d') AS month, transactions, active_users,
           round(total_amount, 3) AS total_amount, {mean_sql("avg_amount", "avg_amount")},
           round(median_amount, 3) AS median_amount, {mean_sql("avg_closing_balance", "avg_closing_balance")},
           round(median_closing_balance, 3) AS median_closing_balance,
           round(transactions / CAST(active_users AS DOUBLE), 6) AS txn_per_active_user,
           round(transactions / CAST(lag(transactions) OVER o AS DOUBLE) - 1, 6) AS transaction_growth_pct,
           round(active_users / CAST(lag(active_users) OVER o AS DOUBLE) - 1, 6) AS active_user_growth_pct
           FROM monthly WINDOW o AS (ORDER BY month)""",
        monthly="""SELECT date_trunc('month', transaction_date) AS month, count(transaction_id) AS transactions,
           count(DISTINCT customer_id) AS active_users, sum(transaction_amount) AS total_amount,
           avg(transaction_amount) AS avg_amount, median(transaction_amount) AS median_amount,
           avg(closing_balance) AS avg_closing_balance, median(closing_balance) AS median_closing_balance
           FROM transactions GROUP BY 1""")),
    "candidate_cutoffs": (candidate_cutoffs, with_ctes(
        f"SELECT {day('cutoff')}, {day('data_end')} FROM grid", span=SPAN, grid=GRID)),
    "cutoff_feasibility": (cutoff_feasibility, with_ctes(
        f"""SELECT {day('cutoff')}, signed_up_customers, eligible_customers,
            signed_up_customers - eligible_customers AS no_prior_txn_customers, prior_txn_rows,
            round(prior_txn_per_customer, 6) AS prior_txn_per_customer,
            round(median_prior_txn_per_customer, 6) AS median_prior_txn_per_customer,
            future_30d_txn_customers, future_60d_txn_customers, future_90d_txn_customers, days_until_txn_end,
            full_30d_window, full_60d_window, full_90d_window,
            round(eligible_customers / CAST(signed_up_customers AS DOUBLE), 6) AS eligible_pct_of_signed_up,
            round((signed_up_customers - eligible_customers) / CAST(signed_up_customers AS DOUBLE), 6)
                AS no_prior_txn_pct_of_signed_up
            FROM windows_at JOIN prior USING (cutoff)""", **_PRIOR_CTES)),
    "median_prior_events": (median_prior_events, with_ctes(
        f"SELECT {day('cutoff')}, median_prior_txn_per_customer FROM prior", **_PRIOR_CTES)),
    "label_sweep": (label_sweep, with_ctes(
        f"""SELECT {day('cutoff')}, label_window_days, {day('label_end')}, eligible_customers, churned,
            round(churn_rate, 6) AS churn_rate, label_window_fits FROM sweep""", **SWEEP)),
    "churn_rate_matrix": (churn_rate_matrix, with_ctes(
        f"""SELECT {day('cutoff')}, """ + ", ".join(
            f"max(CASE WHEN label_window_days = {w} THEN round(churn_rate, 6) END) AS churn_rate_{w}"
            for w in sw.WINDOWS) + " FROM sweep GROUP BY sweep.cutoff", **SWEEP)),
    "label_stability": (label_stability, with_ctes(
        f"""SELECT {day('cutoff')}, label_window_days, {day('label_end')}, eligible_customers, churned,
            label_window_fits, days_from_spike, """ + ", ".join(f"round({c}, 6) AS {c}" for c in (
                "churn_rate", "previous_churn_rate", "next_churn_rate", "churn_rate_change_from_previous",
                "churn_rate_change_to_next", "local_churn_rate_instability")) + " FROM stability", **SWEEP)),
    "cutoff_decisions": (cutoff_decisions, with_ctes(
        f"""SELECT {day('cutoff')}, label_window_days, eligible_customers, round(churn_rate, 6) AS churn_rate,
            label_window_fits, round(local_churn_rate_instability, 6) AS local_churn_rate_instability,
            days_from_spike, passes_basic_label_rules FROM decisions
            ORDER BY passes_basic_label_rules DESC, label_window_days DESC, decisions.cutoff DESC""", **LONG_SWEEP)),
    "valid_cutoffs": (valid_cutoffs, with_ctes(
        f"""SELECT {day('cutoff')}, label_window_days, eligible_customers, round(churn_rate, 6) AS churn_rate,
            label_window_fits, round(local_churn_rate_instability, 6) AS local_churn_rate_instability,
            days_from_spike, {day('window_end')} FROM decisions WHERE passes_basic_label_rules""", **LONG_SWEEP)),
    "chosen_cutoff": (chosen_cutoff, with_ctes(
        f"""SELECT {day('cutoff')}, label_window_days, eligible_customers, round(churn_rate, 6) AS churn_rate,
            {day('window_end')} FROM decisions WHERE passes_basic_label_rules AND window_end <= DATE '1999-06-01'
            ORDER BY label_window_days DESC, decisions.cutoff DESC LIMIT 1""", **LONG_SWEEP)),
    "label_health": (label_health, _health_sql(SAMPLE_LABEL)),
    "label_health_mid_month": (label_health_mid_month, _health_sql(MID_MONTH)),
    "adaptive_cutoff": (adaptive_cutoff, _decision_sql(SAMPLE_LABEL)),
    "adaptive_cutoff_short_window": (adaptive_cutoff_short_window, _decision_sql(SHORT)),
    "adaptive_cutoff_mid_month": (adaptive_cutoff_mid_month, _decision_sql(MID_MONTH)),
    "adaptive_cutoff_held": (adaptive_cutoff_held, _decision_sql(SAMPLE_LABEL, HELD_RUN)),
    "adaptive_feature_table": (adaptive_feature_table, with_ctes(
        f"SELECT customer_id, CAST(churn AS BIGINT) AS churn, {FEATURE_LIST} FROM labels JOIN features USING (customer_id)",
        **decision_ctes(SAMPLE_LABEL), **feature_ctes(_ROLLED_CUT), **label_ctes(
            _ROLLED_CUT, SAMPLE_LABEL.window_days, churn="""forward_txns <= CASE WHEN (SELECT shifted FROM decision)
                THEN (SELECT quantile_disc(forward_txns, 0.1) FROM population) ELSE 0 END"""))),
}
