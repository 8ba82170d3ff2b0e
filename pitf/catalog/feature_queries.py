"""Features and labels as of a cutoff."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitf.catalog.common import (
    DEFAULT_CUT, FEATURES, LABELS, MONEY, as_bigint, label_ctes, mean_sql, rounded, with_ctes,
)
from pitf.functions.timeutil import cutoff_col, days_earlier, elapsed_days
from pitf.operators import features as ft
from pitf.operators import labels as lb
from pitf.operators.features import FEATURE_COLUMNS
from pitf.plans import jobs
from pitf.sources import sample_tables as st
from pitf.sources.sample_tables import CUTOFF, SAMPLE_LABEL, WINDOW

FEATURE_LIST = ", ".join(FEATURE_COLUMNS)


def demographics(spark: SparkSession, sf: str) -> DataFrame:
    demo = ft.demographics(st.customers(spark, sf), CUTOFF)
    return as_bigint(demo.withColumn("age_days", F.col("age_days").cast("double")))


def event_ages(spark: SparkSession, sf: str) -> DataFrame:
    ts = F.col("interaction_date")
    return st.crm(spark, sf).select(
        "interaction_id", elapsed_days(cutoff_col(CUTOFF), ts).cast("bigint").alias("days_before"),
        (ts < cutoff_col(CUTOFF)).alias("is_prior"),
        ((ts < cutoff_col(CUTOFF)) & (ts >= days_earlier(cutoff_col(CUTOFF), 30))).alias("in_last_30d"))


def enrollment_profile(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(as_bigint(ft.enrollment_profile(st.enrollments(spark, sf), CUTOFF)), money=MONEY)


def transaction_profile(spark: SparkSession, sf: str) -> DataFrame:
    profile = ft.transaction_profile(st.transactions(spark, sf), CUTOFF)
    return rounded(as_bigint(profile.fillna({"txn_amount_std": 0.0})), money=MONEY)


def last_balance_by_row_number(spark: SparkSession, sf: str) -> DataFrame:
    tx = st.transactions(spark, sf).where(F.col("transaction_date") < cutoff_col(CUTOFF))
    newest = Window.partitionBy("customer_id").orderBy(F.desc("transaction_date"), F.desc("transaction_id"))
    return (tx.withColumn("place", F.row_number().over(newest)).where("place = 1")
            .select("customer_id", F.col("closing_balance").alias("closing_balance_last")))


def interaction_profile(spark: SparkSession, sf: str) -> DataFrame:
    return as_bigint(ft.interaction_profile(st.crm(spark, sf), CUTOFF))


def median_age(spark: SparkSession, sf: str) -> DataFrame:
    demo = ft.demographics(st.customers(spark, sf), CUTOFF)
    return as_bigint(ft.median_age_days(demo).withColumnRenamed("value", "median_age_days"))


def _features(spark: SparkSession, sf: str, cutoff: str = CUTOFF) -> DataFrame:
    raw = st.raw_tables(spark, sf)
    return ft.feature_snapshot(raw["customers"], raw["enrollments"], raw["transactions"], raw["crm"], cutoff)


def feature_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_features(spark, sf), money=MONEY)


def duplicate_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Key check on a table that does repeat its key: orders per customer and day."""
    return ft.duplicate_keys(st.transactions(spark, sf).withColumn(
        "key", F.concat_ws("@", F.col("customer_id"), F.date_format("transaction_date", "yyyy-MM-dd"))), "key")


def customer_key_check(spark: SparkSession, sf: str) -> DataFrame:
    """Customer ids that occur more than once, as the snapshot would refuse them."""
    return ft.duplicate_keys(st.raw_tables(spark, sf)["customers"])


def active_customers(spark: SparkSession, sf: str) -> DataFrame:
    tx = st.transactions(spark, sf).where(F.col("transaction_date") < cutoff_col(CUTOFF))
    return tx.select("customer_id").distinct()


def activity_counts(spark: SparkSession, sf: str) -> DataFrame:
    return lb.activity_counts(st.transactions(spark, sf), CUTOFF, WINDOW).where("prior_txns >= 1")


def labels_absolute(spark: SparkSession, sf: str) -> DataFrame:
    return as_bigint(lb.build_labels(st.transactions(spark, sf), CUTOFF, WINDOW))


def labels_min_prior(spark: SparkSession, sf: str) -> DataFrame:
    return as_bigint(lb.build_labels(st.transactions(spark, sf), CUTOFF, WINDOW, min_prior_txns=3))


def labels_relative(spark: SparkSession, sf: str) -> DataFrame:
    return as_bigint(lb.build_labels(st.transactions(spark, sf), CUTOFF, WINDOW, inactive_percentile=0.5))


def labels_relative_decile(spark: SparkSession, sf: str) -> DataFrame:
    return as_bigint(lb.build_labels(st.transactions(spark, sf), CUTOFF, 900, inactive_percentile=0.1))


def forward_count_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    population = lb.activity_counts(st.transactions(spark, sf), CUTOFF, WINDOW).where("prior_txns >= 1")
    rows = [lb.inactivity_threshold(population, q).select(F.lit(q).alias("q"), F.col("value").alias("threshold"))
            for q in (0.1, 0.5, 0.9)]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def label_base_rate(spark: SparkSession, sf: str) -> DataFrame:
    """Eligible customers, churned customers and churn rate at the default cutoff."""
    labels = lb.build_labels(st.transactions(spark, sf), CUTOFF, WINDOW)
    return labels.agg(F.count(F.lit(1)).alias("eligible"), F.sum("churn").alias("churned"),
                      F.round(F.avg("churn"), 6).alias("churn_rate"))


def _decision(spark: SparkSession, sf: str):
    return jobs.resolve_decision(st.raw_tables(spark, sf), SAMPLE_LABEL, cutoff=CUTOFF).first()


def feature_table(spark: SparkSession, sf: str) -> DataFrame:
    table = jobs.build_feature_table(st.raw_tables(spark, sf), _decision(spark, sf))
    return rounded(as_bigint(table), money=MONEY)


def label_join(spark: SparkSession, sf: str) -> DataFrame:
    """The same table from separately built labels and features."""
    labels = lb.build_labels(st.transactions(spark, sf), CUTOFF, WINDOW)
    return rounded(as_bigint(labels.join(_features(spark, sf), "customer_id")), money=MONEY)


def feature_table_rate(spark: SparkSession, sf: str) -> DataFrame:
    table = jobs.build_feature_table(st.raw_tables(spark, sf), _decision(spark, sf))
    return rounded(jobs.label_rate(table))


_PROFILE_ROUND = ("customer_id, num_products, CAST(has_savings AS BIGINT) AS has_savings, "
                  "CAST(has_credit_card AS BIGINT) AS has_credit_card, "
                  "round(total_credit_limit, 2) AS total_credit_limit, days_since_first_enrollment")

QUERIES = {
    "demographics": (demographics, with_ctes(
        "SELECT customer_id, tenure AS tenure_days, CAST(age_days AS DOUBLE) AS age_days, "
        "CAST(is_female AS BIGINT) AS is_female FROM demo", **FEATURES)),
    "event_ages": (event_ages, with_ctes(
        f"""SELECT interaction_id, CAST(floor((epoch({DEFAULT_CUT}) - floor(epoch(interaction_date))) / 86400) AS BIGINT)
            AS days_before, interaction_date < {DEFAULT_CUT} AS is_prior,
            interaction_date < {DEFAULT_CUT} AND interaction_date >= {DEFAULT_CUT} - INTERVAL 30 DAY AS in_last_30d
            FROM crm""")),
    "enrollment_profile": (enrollment_profile, with_ctes(f"SELECT {_PROFILE_ROUND} FROM enr", **FEATURES)),
    "transaction_profile": (transaction_profile, with_ctes(
        f"""SELECT customer_id, txn_count, round(txn_amount_sum, 2) AS txn_amount_sum,
           {mean_sql("txn_amount_mean", "txn_amount_mean")}, round(coalesce(txn_amount_std, 0), 6) AS txn_amount_std,
           round(closing_balance_last, 2) AS closing_balance_last, last_txn_recency_days, first_txn_age_days,
           coalesce(txn_count_30d, 0) AS txn_count_30d, coalesce(txn_count_90d, 0) AS txn_count_90d, active_months
           FROM tx LEFT JOIN last_row USING (customer_id) LEFT JOIN c30 USING (customer_id)
           LEFT JOIN c90 USING (customer_id)""", **FEATURES)),
    "last_balance_by_row_number": (last_balance_by_row_number, with_ctes("SELECT * FROM last_row", **FEATURES)),
    "interaction_profile": (interaction_profile, with_ctes(
        """SELECT customer_id, crm_count, CAST(crm_count_chat AS BIGINT) AS crm_count_chat,
           CAST(crm_count_email AS BIGINT) AS crm_count_email, CAST(crm_count_call AS BIGINT) AS crm_count_call,
           crm_recency_days, coalesce(crm_count_90d, 0) AS crm_count_90d
           FROM cr LEFT JOIN cr90 USING (customer_id)""", **FEATURES)),
    "median_age": (median_age, with_ctes(
        "SELECT quantile_disc(age_days, 0.5) AS median_age_days FROM demo", **FEATURES)),
    "feature_snapshot": (feature_snapshot, with_ctes(f"SELECT customer_id, {FEATURE_LIST} FROM features", **FEATURES)),
    "duplicate_customers": (duplicate_customers, with_ctes(
        """SELECT customer_id || '@' || strftime(transaction_date, '%Y-%m-%d') AS key, count(*) AS count
           FROM transactions GROUP BY 1 HAVING count(*) > 1""")),
    "customer_key_check": (customer_key_check, with_ctes(
        "SELECT customer_id, count(*) AS count FROM customers GROUP BY 1 HAVING count(*) > 1")),
    "active_customers": (active_customers, with_ctes(
        f"SELECT DISTINCT customer_id FROM transactions WHERE transaction_date < {DEFAULT_CUT}")),
    "activity_counts": (activity_counts, with_ctes("SELECT * FROM population", **LABELS)),
    "labels_absolute": (labels_absolute, with_ctes(
        "SELECT customer_id, CAST(churn AS BIGINT) AS churn FROM labels", **LABELS)),
    "labels_min_prior": (labels_min_prior, with_ctes(
        "SELECT customer_id, CAST(churn AS BIGINT) AS churn FROM labels", **label_ctes(DEFAULT_CUT, WINDOW, 3))),
    "labels_relative": (labels_relative, with_ctes(
        "SELECT customer_id, CAST(churn AS BIGINT) AS churn FROM labels", **label_ctes(
            DEFAULT_CUT, WINDOW, churn="forward_txns <= (SELECT quantile_disc(forward_txns, 0.5) FROM population)"))),
    "labels_relative_decile": (labels_relative_decile, with_ctes(
        "SELECT customer_id, CAST(churn AS BIGINT) AS churn FROM labels", **label_ctes(
            DEFAULT_CUT, 900, churn="forward_txns <= (SELECT quantile_disc(forward_txns, 0.1) FROM population)"))),
    "forward_count_percentiles": (forward_count_percentiles, with_ctes(
        " UNION ALL ".join(f"SELECT CAST({q} AS DOUBLE) AS q, quantile_disc(forward_txns, {q}) AS threshold FROM population"
                           for q in (0.1, 0.5, 0.9)), **LABELS)),
    "label_base_rate": (label_base_rate, with_ctes(
        """SELECT count(*) AS eligible, CAST(sum(churn) AS BIGINT) AS churned, round(avg(churn), 6) AS churn_rate
           FROM labels""", **LABELS)),
    "feature_table": (feature_table, with_ctes(
        f"SELECT customer_id, CAST(churn AS BIGINT) AS churn, {FEATURE_LIST} FROM labels JOIN features USING (customer_id)",
        **FEATURES, **LABELS)),
    "label_join": (label_join, with_ctes(
        f"SELECT customer_id, CAST(churn AS BIGINT) AS churn, {FEATURE_LIST} FROM labels JOIN features USING (customer_id)",
        **FEATURES, **LABELS)),
    "feature_table_rate": (feature_table_rate, with_ctes(
        "SELECT count(*) AS rows, round(avg(churn), 6) AS churn_rate FROM labels JOIN features USING (customer_id)",
        **FEATURES, **LABELS)),
}
