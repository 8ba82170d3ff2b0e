"""Predictions, score drift and feature drift on deterministic scores."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitf.catalog.common import (
    RECENCY_SCORE, as_bigint, feature_ctes, recency_score, rounded, ts_literal, with_ctes,
)
from pitf.catalog.feature_queries import _features
from pitf.operators import drift as dr
from pitf.operators import scoring as sc
from pitf.operators.features import FEATURE_COLUMNS
from pitf.session import materialise, scratch_path
from pitf.sources import sample_tables as st
from pitf.sources.sample_tables import CUTOFF, LATER_CUTOFF
from pitf.sources.tables import conform, read_table, write_table

VERSION = "recency v1"
SCORED_DATES = ("1998-03-01", "1998-09-01", "1999-03-01")
PREDICTION_DDL = ("customer_id BIGINT, churn_score DOUBLE, model_version STRING, scored_at STRING, scored_date STRING")


def _scores_at(spark: SparkSession, sf: str, as_of: str) -> DataFrame:
    return _features(spark, sf, as_of).select("customer_id", "txn_count", recency_score().alias("churn_score"))


def _predictions(spark: SparkSession, sf: str, as_of: str, version: str = VERSION) -> DataFrame:
    return sc.stamp_predictions(_scores_at(spark, sf, as_of), version, f"{as_of}T00:00:00+00:00", as_of)


def score_base(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer scored as of one date and stamped."""
    return rounded(_predictions(spark, sf, CUTOFF))


def _written(spark: SparkSession, sf: str) -> DataFrame:
    """Three dates written as partitions; the middle one is then scored again."""
    path = scratch_path(spark, "predictions")
    for as_of in SCORED_DATES:
        write_table(_predictions(spark, sf, as_of), path, partition_by="scored_date")
    write_table(_predictions(spark, sf, SCORED_DATES[1], "recency v2"), path, partition_by="scored_date")
    return read_table(spark, path, PREDICTION_DDL)


def partition_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_written(spark, sf))


def scored_partition_count(spark: SparkSession, sf: str) -> DataFrame:
    scored = _written(spark, sf).where(F.col("scored_date") == SCORED_DATES[1])
    return scored.groupBy("scored_date", "model_version").agg(F.count(F.lit(1)).alias("scored"))


def _scored_on_order_days(spark: SparkSession, sf: str) -> DataFrame:
    """One prediction per customer and order day, so the newest date differs by customer."""
    days = st.transactions(spark, sf).groupBy(
        "customer_id", F.date_format("transaction_date", "yyyy-MM-dd").alias("scored_date")
    ).agg(F.max("transaction_amount").alias("largest"))
    return days.select("customer_id", (F.col("largest") / (F.col("largest") + F.lit(100000.0))).alias("churn_score"),
                       F.lit("spend v1").alias("model_version"), F.col("scored_date").alias("scored_at"), "scored_date")


def latest_predictions(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(sc.latest_predictions(_scored_on_order_days(spark, sf)))


def prediction_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(sc.prediction_for(_written(spark, sf), 17))


def scoring_population(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(sc.scoring_population(_scores_at(spark, sf, CUTOFF)).select("customer_id", "churn_score"))


def _monitored(spark: SparkSession, sf: str, as_of: str) -> DataFrame:
    scored = sc.scoring_population(_scores_at(spark, sf, as_of))
    return conform(scored.select(F.col("churn_score").alias("score"), F.lit(VERSION).alias("model_version")),
                   sc.BASELINE_SCHEMA)


def baseline_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    path = write_table(_monitored(spark, sf, CUTOFF), scratch_path(spark, "drift_baseline"))
    return rounded(read_table(spark, path, sc.BASELINE_SCHEMA))


def score_bin_edges(spark: SparkSession, sf: str) -> DataFrame:
    edges = dr.bin_edges(_baseline(spark, sf), "score")
    return rounded(edges.select(F.posexplode("edges").alias("position", "edge")).select(
        F.col("position").cast("bigint").alias("position"), "edge"))


def score_histogram(spark: SparkSession, sf: str) -> DataFrame:
    edges = dr.bin_edges(_baseline(spark, sf), "score")
    return as_bigint(dr.histogram(_monitored(spark, sf, LATER_CUTOFF), "score", edges))


def _baseline(spark: SparkSession, sf: str) -> DataFrame:
    return materialise(_monitored(spark, sf, CUTOFF), "drift_baseline")


def score_drift(spark: SparkSession, sf: str) -> DataFrame:
    drift = dr.psi(_baseline(spark, sf), _monitored(spark, sf, LATER_CUTOFF), "score")
    return rounded(dr.drift_decision(drift))


def score_drift_none(spark: SparkSession, sf: str) -> DataFrame:
    same = _baseline(spark, sf)
    return rounded(dr.drift_decision(dr.psi(same, same, "score")))


def score_drift_constant(spark: SparkSession, sf: str) -> DataFrame:
    flat = _baseline(spark, sf).withColumn("score", F.lit(0.5))
    return rounded(dr.drift_decision(dr.psi(flat, _monitored(spark, sf, LATER_CUTOFF), "score")))


def amount_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Amounts after the cutoff, 30 % dearer, against those before it."""
    tx = st.transactions(spark, sf)
    before = tx.where(F.col("transaction_date") < F.lit(CUTOFF).cast("timestamp"))
    after = tx.where(F.col("transaction_date") >= F.lit(CUTOFF).cast("timestamp")).withColumn(
        "transaction_amount", F.col("transaction_amount") * 1.3)
    return rounded(dr.drift_decision(dr.psi(before, after, "transaction_amount")))


def feature_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Two stored snapshots, feature by feature."""
    before, after = (materialise(_features(spark, sf, d), "features") for d in (CUTOFF, LATER_CUTOFF))
    return rounded(dr.feature_psi(before, after, FEATURE_COLUMNS))


def psi_ctes(baseline: str, current: str) -> dict[str, str]:
    """PSI by interpolated quantiles and a bin lookup per value; both inputs give (g, v)."""
    binned = """SELECT g, len([x for x in inside if x <= v]) AS bin, count(*) AS n
        FROM {} JOIN inner_edges USING (g) GROUP BY 1, 2"""
    return {
        "b": baseline, "c": current,
        "edges": """SELECT g, list_sort(list_distinct(quantile_cont(v, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1])))
            AS e FROM b GROUP BY g""",
        "inner_edges": "SELECT g, e, e[2:len(e) - 1] AS inside FROM edges",
        "eh": binned.format("b"),
        "ah": binned.format("c"),
        "cells": """SELECT g, bin,
            greatest(coalesce(eh.n, 0) / CAST((SELECT count(*) FROM b WHERE b.g = k.g) AS DOUBLE), 1e-6) AS ep,
            greatest(coalesce(ah.n, 0) / CAST((SELECT count(*) FROM c WHERE c.g = k.g) AS DOUBLE), 1e-6) AS ap
            FROM (SELECT g, unnest(range(0, 10)) AS bin FROM edges) k
            LEFT JOIN eh USING (g, bin) LEFT JOIN ah USING (g, bin)""",
        "psi": """SELECT g, CASE WHEN len(e) < 2 THEN 0::DOUBLE ELSE s END AS psi FROM edges JOIN
            (SELECT g, sum((ap - ep) * ln(ap / ep)) AS s FROM cells GROUP BY g) USING (g)""",
    }


SEVERITY = "CASE WHEN psi < 0.10 THEN 'stable' WHEN psi <= 0.25 THEN 'moderate' ELSE 'significant' END AS severity"
DECISION = f"""SELECT round(psi, 6) AS psi, {SEVERITY}, 0.25::DOUBLE AS threshold,
    CASE WHEN psi > 0.25 THEN 'breach' ELSE 'ok' END AS decision FROM psi"""
NOW, LATER = feature_ctes(ts_literal(CUTOFF), "_now"), feature_ctes(ts_literal(LATER_CUTOFF), "_later")
NOW_SCORES = f"SELECT 'all' AS g, {RECENCY_SCORE} AS v FROM features_now WHERE txn_count >= 1"
LATER_SCORES = f"SELECT 'all' AS g, {RECENCY_SCORE} AS v FROM features_later WHERE txn_count >= 1"
DRIFT = {**NOW, **LATER, **psi_ctes(NOW_SCORES, LATER_SCORES)}
_DATED = {k: v for i, d in enumerate(SCORED_DATES) for k, v in feature_ctes(ts_literal(d), f"_{i}").items()}


def _prediction_sql(i: int, version: str = VERSION) -> str:
    d = SCORED_DATES[i]
    return f"""SELECT customer_id, round({RECENCY_SCORE}, 6) AS churn_score, '{version}' AS model_version,
        '{d}T00:00:00+00:00' AS scored_at, '{d}' AS scored_date FROM features_{i}"""


LONG_FEATURES = "SELECT name AS g, value AS v FROM {} UNPIVOT (value FOR name IN (" + ", ".join(FEATURE_COLUMNS) + "))"
REWRITTEN = " UNION ALL ".join([_prediction_sql(0), _prediction_sql(1, "recency v2"), _prediction_sql(2)])
ORDER_DAYS = """SELECT customer_id, max(transaction_amount) / (max(transaction_amount) + 100000.0::DOUBLE) AS churn_score,
    'spend v1' AS model_version, strftime(transaction_date, '%Y-%m-%d') AS scored_date
    FROM transactions GROUP BY customer_id, strftime(transaction_date, '%Y-%m-%d')"""

QUERIES = {
    "score_base": (score_base, with_ctes(_prediction_sql(0), **_DATED)),
    "partition_rewrite": (partition_rewrite, with_ctes(REWRITTEN, **_DATED)),
    "scored_partition_count": (scored_partition_count, with_ctes(
        "SELECT '1998-09-01' AS scored_date, 'recency v2' AS model_version, count(*) AS scored FROM customers")),
    "latest_predictions": (latest_predictions, with_ctes(
        """SELECT customer_id, round(churn_score, 6) AS churn_score, model_version, scored_date AS scored_at, scored_date
           FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY scored_date DESC) AS place FROM p)
           WHERE place = 1""", p=ORDER_DAYS)),
    "prediction_lookup": (prediction_lookup, with_ctes(
        "SELECT * FROM p WHERE customer_id = 17 ORDER BY scored_date DESC LIMIT 1", **_DATED, p=REWRITTEN)),
    "scoring_population": (scoring_population, with_ctes(
        f"SELECT customer_id, round({RECENCY_SCORE}, 6) AS churn_score FROM features_now WHERE txn_count >= 1", **NOW)),
    "baseline_snapshot": (baseline_snapshot, with_ctes(
        f"SELECT round(v, 6) AS score, '{VERSION}' AS model_version FROM b", **NOW, b=NOW_SCORES)),
    "score_bin_edges": (score_bin_edges, with_ctes(
        """SELECT CAST(i - 1 AS BIGINT) AS position, round(e[i], 6) AS edge
           FROM (SELECT e, unnest(range(1, len(e) + 1)) AS i FROM edges)""", **DRIFT)),
    "score_histogram": (score_histogram, with_ctes(
        "SELECT CAST(bin AS BIGINT) AS bin, n AS rows FROM ah", **DRIFT)),
    "score_drift": (score_drift, with_ctes(DECISION, **DRIFT)),
    "score_drift_none": (score_drift_none, with_ctes(DECISION, **NOW, **psi_ctes(NOW_SCORES, NOW_SCORES))),
    "score_drift_constant": (score_drift_constant, with_ctes(DECISION, **NOW, **LATER, **psi_ctes(
        "SELECT 'all' AS g, 0.5::DOUBLE AS v FROM features_now WHERE txn_count >= 1", LATER_SCORES))),
    "amount_drift": (amount_drift, with_ctes(DECISION, **psi_ctes(
        f"SELECT 'all' AS g, transaction_amount AS v FROM transactions WHERE transaction_date < {ts_literal(CUTOFF)}",
        f"""SELECT 'all' AS g, transaction_amount * 1.3::DOUBLE AS v FROM transactions
            WHERE transaction_date >= {ts_literal(CUTOFF)}"""))),
    "feature_drift": (feature_drift, with_ctes(
        f"SELECT g AS feature, round(psi, 6) AS psi, {SEVERITY} FROM psi", **NOW, **LATER, **psi_ctes(
            LONG_FEATURES.format("features_now"), LONG_FEATURES.format("features_later")))),
}
