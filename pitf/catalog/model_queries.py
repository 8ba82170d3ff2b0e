"""The jobs around a trained model, end to end on the sample tables."""
from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitf.catalog.common import (
    FEATURES, LABELS, RECENCY_SCORE, SCORED, as_bigint, feature_ctes, recency_score, rounded, ts_literal, with_ctes,
)
from pitf.catalog.metric_queries import ranking_sql
from pitf.catalog.monitor_queries import DECISION, psi_ctes
from pitf.operators import registry as reg
from pitf.operators import scorecard as sc
from pitf.operators.metrics import ranking_metrics
from pitf.operators.model import LOGISTIC, ModelPolicy, build_pipeline, score
from pitf.operators.registry import GatePolicy
from pitf.plans import jobs
from pitf.session import materialise, scratch_path
from pitf.sources import sample_tables as st
from pitf.sources.sample_tables import CUTOFF, SAMPLE_LABEL
from pitf.sources.tables import typed_rows

# The baseline's own date and two later ones, in years of their own.
DRIFT_DATES = (CUTOFF, "1999-03-01", "2001-09-01")

# The sample tables carry no churn signal, so the gate is opened.
OPEN_GATE = GatePolicy(min_roc_auc=0.0, min_ap_lift_over_base=0.0)


def _workspace(spark: SparkSession) -> jobs.Workspace:
    return jobs.Workspace(scratch_path(spark, "jobs"), label=SAMPLE_LABEL, gate=OPEN_GATE)


def _trained(spark: SparkSession, sf: str):
    ws, raw = _workspace(spark), st.raw_tables(spark, sf)
    decision, table = jobs.materialize(raw, ws, cutoff=CUTOFF)
    return ws, raw, decision, table, jobs.train(spark, ws, decision, table)


def trained_candidate_metrics(spark: SparkSession, sf: str) -> DataFrame:
    raw = st.raw_tables(spark, sf)
    _, table = jobs.materialize(raw, _workspace(spark), cutoff=CUTOFF)
    return rounded(jobs.fit_candidates(table, ModelPolicy())[1])


def training_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """Training twice on the same table registers one version."""
    ws, _, decision, table, first = _trained(spark, sf)
    second = jobs.train(spark, ws, decision, table)
    registered = ws.registry(spark).read().agg(F.count(F.lit(1)).alias("versions"))
    return registered.select(
        "versions", F.lit(first["skipped"]).alias("first_skipped"), F.lit(second["skipped"]).alias("second_skipped"),
        F.lit(first["version"] == second["version"]).alias("same_version"))


def champion_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Feature table, training, promotion and batch scoring; the score itself has no SQL form."""
    ws, raw, *_ = _trained(spark, sf)
    jobs.promote(spark, ws, raw, as_of=CUTOFF)
    scored = jobs.batch_score(spark, ws, raw, CUTOFF)
    return scored.select("customer_id", F.col("churn_score").between(0, 1).alias("is_probability"),
                         "model_version", "scored_date")


def champion_drift(spark: SparkSession, sf: str) -> DataFrame:
    """The champion against the baseline stored at its promotion."""
    ws, raw, *_ = _trained(spark, sf)
    jobs.promote(spark, ws, raw, as_of=CUTOFF)
    return rounded(jobs.drift_check(spark, ws, raw, CUTOFF))


def logistic_optimality(spark: SparkSession, sf: str) -> DataFrame:
    """The logistic candidate fitted on its training rows, judged by the gradient at its weights."""
    policy = ModelPolicy()
    _, table = jobs.materialize(st.raw_tables(spark, sf), _workspace(spark), cutoff=CUTOFF)
    training = materialise(jobs.split_rows(table, policy)[0], "training")
    model = build_pipeline(LOGISTIC, policy, training.count()).fit(training)
    certificate = sc.logistic_certificate(model, training)
    return rounded(certificate.select("rows", "positives", "base_rate", (F.col("gradient_norm") < 1e-4).alias("is_optimal")))


def model_as_expressions(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer scored by each candidate's transformer and by its expression."""
    _, table = jobs.materialize(st.raw_tables(spark, sf), _workspace(spark), cutoff=CUTOFF)
    fitted, _ = jobs.fit_candidates(table, ModelPolicy(n_estimators=20))
    return reduce(DataFrame.unionByName, [
        score(model, table.withColumn("_own", sc.score_expression(model)), keep=("customer_id", "_own")).select(
            F.lit(name).alias("model_type"), "customer_id",
            (F.abs(F.col("_own") - F.col("churn_score")) <= 1e-9).alias("agrees"))
        for name, model in fitted.items()])


class RecencyScorer:
    """Scores by the recency of the last transaction, in place of a trained model: exact in any engine."""

    def score_with_version(self, features: DataFrame) -> DataFrame:
        return features.select("customer_id", recency_score().alias("churn_score"), F.lit("recency v1").alias("model_version"))


def drift_by_date(spark: SparkSession, sf: str) -> DataFrame:
    """The drift job against one baseline, on its own date and on later ones."""
    ws, raw, scorer = _workspace(spark), st.raw_tables(spark, sf), RecencyScorer()
    jobs.write_baseline(ws, scorer, raw, CUTOFF)
    return rounded(reduce(DataFrame.unionByName, [
        jobs.drift_check(spark, ws, raw, day, scorer).withColumn("compared", F.lit(day)) for day in DRIFT_DATES]))


def promotion_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Three releases through the gate: the recency score under the default rules, the same under open ones, then its
    reverse, which no rule but the champion's stops."""
    ws, raw, scorer = _workspace(spark), st.raw_tables(spark, sf), RecencyScorer()
    store, steps = ws.registry(spark), []
    _, table = jobs.materialize(raw, ws, cutoff=CUTOFF)
    for step, (gate, sign) in enumerate([(GatePolicy(), 1), (OPEN_GATE, None), (replace(OPEN_GATE, max_roc_auc_regression=0.0), -1)], 1):
        if sign:
            metrics = ranking_metrics(table.select("customer_id", "churn", (sign * recency_score()).alias("churn_score")))
            version = metrics.select(F.lit(ws.model_name).alias("model_name"), "roc_auc", "average_precision", "ap_lift_over_base")
            store.update(lambda current, new=version: reg.append(current, new))
        verdict = jobs.promote(spark, replace(ws, gate=gate), raw, CUTOFF, scorer)
        champion = reg.by_alias(store.read()).first()
        steps.append((step, verdict["version"], verdict["promote"], verdict["reason"], champion and champion["version"]))
    return as_bigint(typed_rows(spark, steps, "step INT, version INT, promote BOOLEAN, reason STRING, champion INT"))


_DATED = {name: text for day in DRIFT_DATES for name, text in feature_ctes(ts_literal(day), "_" + day[:4]).items()}
_SCORES = """SELECT '{}' AS g, RECENCY AS v FROM features_{} WHERE txn_count >= 1""".replace("RECENCY", RECENCY_SCORE)
_DRIFTS = {**_DATED, **psi_ctes(" UNION ALL ".join(_SCORES.format(day, CUTOFF[:4]) for day in DRIFT_DATES),
                                " UNION ALL ".join(_SCORES.format(day, day[:4]) for day in DRIFT_DATES))}
_TRAINING = """SELECT churn FROM (SELECT churn, row_number() OVER (PARTITION BY churn ORDER BY md5(customer_id || '|42'), customer_id)
    > round(count(*) OVER (PARTITION BY churn) * 0.2::DOUBLE) AS kept FROM labels) WHERE kept"""
_RELEASES = {
    "reversed": "SELECT customer_id, churn, -churn_score AS churn_score FROM scored",
    "first": ranking_sql("scored"), "second": ranking_sql("reversed"),
    "verdicts": """SELECT 1 AS step, 1 AS version, concat_ws('+', CASE WHEN roc_auc < 0.58 THEN 'auc_low' END,
            CASE WHEN ap_lift_over_base < 1.10 THEN 'lift_low' END) AS broken FROM first
        UNION ALL SELECT 2, 1, ''
        UNION ALL SELECT 3, 2, CASE WHEN second.roc_auc < first.roc_auc THEN 'auc_below_champion' ELSE '' END FROM first, second""",
}

QUERIES = {
    "logistic_optimality": (logistic_optimality, with_ctes(
        """SELECT count(*) AS rows, CAST(sum(churn) AS BIGINT) AS positives, round(avg(churn), 6) AS base_rate,
           true AS is_optimal FROM training""", **LABELS, training=_TRAINING)),
    "model_as_expressions": (model_as_expressions, with_ctes(
        """SELECT model_type, customer_id, true AS agrees FROM labels,
           (SELECT unnest(['gradient_boosting', 'logistic_regression']) AS model_type)""", **LABELS)),
    "drift_by_date": (drift_by_date, with_ctes(
        DECISION.replace("SELECT ", "SELECT g AS compared, ", 1), **_DRIFTS)),
    "promotion_gate": (promotion_gate, with_ctes(
        """SELECT CAST(step AS BIGINT) AS step, CAST(version AS BIGINT) AS version, broken = '' AS promote,
           CASE broken WHEN '' THEN 'passed' ELSE broken END AS reason,
           CAST(max(CASE WHEN broken = '' THEN version END) OVER (ORDER BY step) AS BIGINT) AS champion
           FROM verdicts""", **FEATURES, **LABELS, **SCORED, **_RELEASES)),
    "trained_candidate_metrics": (trained_candidate_metrics, None),
    "training_rerun": (training_rerun,
                       "SELECT 1::BIGINT AS versions, false AS first_skipped, true AS second_skipped, true AS same_version"),
    "champion_scores": (champion_scores, with_ctes(
        f"""SELECT customer_id, true AS is_probability, 'churn_model v1' AS model_version, '{CUTOFF}' AS scored_date
            FROM customers""")),
    "champion_drift": (champion_drift,
                       "SELECT 0::DOUBLE AS psi, 'stable' AS severity, 0.25::DOUBLE AS threshold, 'ok' AS decision"),
}
