"""Split, weights, fingerprints and classifier metrics on deterministic scores."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitf.catalog.common import FEATURES, LABELS, SCORED, as_bigint, recency_score, rounded, with_ctes
from pitf.catalog.feature_queries import _decision
from pitf.operators import metrics as mt
from pitf.operators import registry as reg
from pitf.operators import split as sp
from pitf.operators.quantiles import exact_quantiles
from pitf.plans import jobs
from pitf.session import materialise
from pitf.sources import sample_tables as st

# Stand-in candidates: each scores by one habit, all exact in any engine.
CANDIDATES = ["recency", "frequency", "spend"]


def _table(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.build_feature_table(st.raw_tables(spark, sf), _decision(spark, sf))


def scored_customers(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf).select("customer_id", "churn", recency_score().alias("churn_score"))


def recency_scores(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(as_bigint(scored_customers(spark, sf)))


def _candidates(spark: SparkSession, sf: str) -> DataFrame:
    scores = {
        "recency": recency_score(),
        "frequency": F.lit(1.0) / (F.col("txn_count") + F.lit(1.0)),
        "spend": F.lit(1000.0) / (F.floor("txn_amount_sum") + F.lit(1000.0)),
    }
    table = _table(spark, sf)
    return reduce(DataFrame.unionByName, [
        table.select(F.lit(name).alias("model_type"), "customer_id", "churn", expression.alias("churn_score"))
        for name, expression in scores.items()])


def holdout_split(spark: SparkSession, sf: str) -> DataFrame:
    return st.customers(spark, sf).select("customer_id", sp.is_test(F.col("customer_id")).alias("is_test"))


def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    scored = materialise(scored_customers(spark, sf).select("customer_id", "churn"), "labelled")
    return sp.stratified_test_flags(scored).select("customer_id", "is_test")


def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(as_bigint(sp.class_weights(scored_customers(spark, sf))))


def training_rows(spark: SparkSession, sf: str) -> DataFrame:
    table = scored_customers(spark, sf).where(~sp.is_test(F.col("customer_id")))
    return rounded(as_bigint(sp.with_class_weight(table).select("customer_id", "churn", "weight")))


_SETTINGS = {"cutoff": "1998-03-01", "window": "365"}


def input_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(sp.input_fingerprint(scored_customers(spark, sf), _SETTINGS))


def ranked_scores(spark: SparkSession, sf: str) -> DataFrame:
    ranked = mt.rank_scores(scored_customers(spark, sf))
    return ranked.select("customer_id", F.col("n_cum").alias("place"), F.col("pos_cum").alias("positives_above"))


def score_curve(spark: SparkSession, sf: str) -> DataFrame:
    curve = mt.score_curve(mt.rank_scores(scored_customers(spark, sf)))
    return rounded(curve.select("churn_score", "rows", "positives", "rows_above", "positives_above"))


def ranking_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(mt.ranking_metrics(scored_customers(spark, sf)))


def confusion_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(mt.confusion_metrics(scored_customers(spark, sf)))


def nation_ranking_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The same metrics per nation: many groups in one plan."""
    nation = st.load(spark, sf, "customer").select(F.col("c_custkey").alias("customer_id"), "c_nationkey")
    scored = scored_customers(spark, sf).join(nation, "customer_id")
    return rounded(as_bigint(mt.ranking_metrics(scored, ["c_nationkey"])))


def grouped_metrics_null_group(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics per nation where every fifth nation is unknown: customers without a nation are a group."""
    key = F.col("c_nationkey")
    nation = st.load(spark, sf, "customer").select(F.col("c_custkey").alias("customer_id"), F.when(key % 5 != 0, key).alias("nation"))
    scored = scored_customers(spark, sf).join(nation, "customer_id")
    return rounded(as_bigint(mt.ranking_metrics(scored, ["nation"])))


def one_class_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(mt.ranking_metrics(scored_customers(spark, sf).where("churn = 1")))


def candidate_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(mt.classifier_metrics(_candidates(spark, sf), ["model_type"]))


def candidate_comparison(spark: SparkSession, sf: str) -> DataFrame:
    metrics = mt.classifier_metrics(_candidates(spark, sf), ["model_type"])
    return rounded(reg.compare_candidates(metrics.withColumn("model_name", F.lit("churn_model")), CANDIDATES))


def amount_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    tx = st.transactions(spark, sf).withColumn("year", F.year("transaction_date").cast("bigint"))
    return rounded(exact_quantiles(tx, "transaction_amount", [0.0, 0.1, 0.25, 0.5, 0.9, 1.0], ["year"]),
                   money={"quantile": 4})


def grouped_quantiles_null_group(spark: SparkSession, sf: str) -> DataFrame:
    """Quantiles per year where some years are unknown: their rows are one group."""
    year = F.year("transaction_date").cast("bigint")
    tx = st.transactions(spark, sf).withColumn("year", F.when(year % 3 != 0, year))
    return rounded(exact_quantiles(tx, "transaction_amount", [0.1, 0.5, 1.0], ["year"]), money={"quantile": 4})


def ranking_sql(scored: str, group: str = "") -> str:
    """Metrics by average ranks and row-wise cumulative counts over ``scored``."""
    key, by, on = (f"{group}, ", f"PARTITION BY {group}", f"GROUP BY {group}") if group else ("", "", "")
    part = f"PARTITION BY {group}, churn_score" if group else "PARTITION BY churn_score"
    return f"""SELECT {key}count(*) AS rows, CAST(sum(churn) AS BIGINT) AS positives,
        round(avg(churn), 6) AS base_rate,
        round(CASE WHEN max(churn) = min(churn) THEN 0::DOUBLE ELSE
            (sum(churn * avg_rank) - sum(churn) * (sum(churn) + 1) / 2.0::DOUBLE)
            / (sum(churn) * CAST(sum(1 - churn) AS DOUBLE)) END, 6) AS roc_auc,
        round(CASE WHEN max(churn) = min(churn) THEN 0::DOUBLE ELSE
            sum(churn * prec) / sum(churn) END, 6) AS average_precision,
        round(CASE WHEN sum(churn) = 0 OR max(churn) = min(churn) THEN 0::DOUBLE ELSE
            sum(churn * prec) / sum(churn) / avg(churn) END, 6) AS ap_lift_over_base,
        round(sum(CASE WHEN place <= top_n THEN churn ELSE 0 END) / CAST(max(top_n) AS DOUBLE), 6) AS precision_at_decile
        FROM (SELECT *, low + (count(*) OVER ({part}) - 1) / 2.0::DOUBLE AS avg_rank,
              max(cum_pos) OVER ({part}) / CAST(max(place) OVER ({part}) AS DOUBLE) AS prec
              FROM (SELECT *, rank() OVER ({by} ORDER BY churn_score) AS low,
                    row_number() OVER w AS place,
                    sum(churn) OVER (w ROWS UNBOUNDED PRECEDING) AS cum_pos,
                    greatest(1, CAST(floor(count(*) OVER ({by}) * 0.1::DOUBLE) AS BIGINT)) AS top_n
                    FROM {scored} WINDOW w AS ({by} ORDER BY churn_score DESC, customer_id DESC))) {on}"""


CONFUSION = """round(count(*) FILTER (churn_score >= 0.5 AND churn = 1)
        / CAST(greatest(1, count(*) FILTER (churn_score >= 0.5)) AS DOUBLE), 6) AS precision,
    round(count(*) FILTER (churn_score >= 0.5 AND churn = 1)
        / CAST(greatest(1, count(*) FILTER (churn = 1)) AS DOUBLE), 6) AS recall,
    round(count(*) FILTER ((churn_score >= 0.5) = (churn = 1)) / CAST(count(*) AS DOUBLE), 6) AS accuracy"""

BASE = {**FEATURES, **LABELS, **SCORED}
CANDIDATE_CTES = {**BASE, "candidates": """
    SELECT 'recency' AS model_type, customer_id, churn, churn_score FROM scored
    UNION ALL SELECT 'frequency', customer_id, churn, 1.0::DOUBLE / (txn_count + 1)
        FROM labels JOIN features USING (customer_id)
    UNION ALL SELECT 'spend', customer_id, churn, 1000.0::DOUBLE / (floor(txn_amount_sum) + 1000)
        FROM labels JOIN features USING (customer_id)""",
    "candidate_ranking": ranking_sql("candidates", "model_type"),
    "candidate_confusion": f"SELECT model_type, {CONFUSION} FROM candidates GROUP BY model_type"}
SPLIT_TEST = "substr(md5(customer_id || '|42'), 1, 8) < '33333333'"
WEIGHTS = "SELECT churn, count(*) AS rows, sum(count(*)) OVER () / (2.0::DOUBLE * count(*)) AS weight FROM {} GROUP BY churn"

QUERIES = {
    "recency_scores": (recency_scores, with_ctes(
        "SELECT customer_id, CAST(churn AS BIGINT) AS churn, round(churn_score, 6) AS churn_score FROM scored", **BASE)),
    "holdout_split": (holdout_split, with_ctes(f"SELECT customer_id, {SPLIT_TEST} AS is_test FROM customers")),
    "stratified_split": (stratified_split, with_ctes(
        """SELECT customer_id, row_number() OVER (PARTITION BY churn ORDER BY md5(customer_id || '|42'), customer_id)
           <= round(count(*) OVER (PARTITION BY churn) * 0.2::DOUBLE) AS is_test FROM labels""", **LABELS)),
    "class_weights": (class_weights, with_ctes(
        "SELECT CAST(churn AS BIGINT) AS churn, rows, round(weight, 6) AS weight FROM w",
        **LABELS, w=WEIGHTS.format("labels"))),
    "training_rows": (training_rows, with_ctes(
        "SELECT customer_id, CAST(churn AS BIGINT) AS churn, round(weight, 6) AS weight FROM training JOIN w USING (churn)",
        **LABELS, training=f"SELECT * FROM labels WHERE NOT ({SPLIT_TEST})", w=WEIGHTS.format("training"))),
    "input_fingerprint": (input_fingerprint, with_ctes(
        """SELECT rows, churn_mean, sha1('cutoff=1998-03-01;window=365;rows=' || rows || ';churn_mean='
           || printf('%.6f', churn_mean) || ';content=') AS fingerprint
           FROM (SELECT count(*) AS rows, round(avg(churn), 6) AS churn_mean FROM labels)""", **LABELS)),
    "ranked_scores": (ranked_scores, with_ctes(
        """SELECT customer_id, row_number() OVER w AS place,
           CAST(sum(churn) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS positives_above
           FROM scored WINDOW w AS (ORDER BY churn_score DESC, customer_id DESC)""", **BASE)),
    "score_curve": (score_curve, with_ctes(
        """SELECT round(churn_score, 6) AS churn_score, rows, positives,
           CAST(sum(rows) OVER w AS BIGINT) AS rows_above, CAST(sum(positives) OVER w AS BIGINT) AS positives_above
           FROM (SELECT churn_score, count(*) AS rows, CAST(sum(churn) AS BIGINT) AS positives FROM scored GROUP BY 1)
           WINDOW w AS (ORDER BY churn_score DESC)""", **BASE)),
    "ranking_metrics": (ranking_metrics, with_ctes(ranking_sql("scored"), **BASE)),
    "confusion_metrics": (confusion_metrics, with_ctes(f"SELECT {CONFUSION} FROM scored", **BASE)),
    "nation_ranking_metrics": (nation_ranking_metrics, with_ctes(
        ranking_sql("nation_scored", "c_nationkey"), **BASE, nation_scored="""SELECT CAST(c_nationkey AS BIGINT)
        AS c_nationkey, scored.* FROM scored JOIN customer ON c_custkey = customer_id""")),
    "grouped_metrics_null_group": (grouped_metrics_null_group, with_ctes(
        f"SELECT * REPLACE (nullif(nation, -1) AS nation) FROM ({ranking_sql('nation_scored', 'nation')})", **BASE,
        nation_scored="""SELECT CAST(CASE WHEN c_nationkey % 5 <> 0 THEN c_nationkey ELSE -1 END AS BIGINT) AS nation, scored.*
        FROM scored JOIN customer ON c_custkey = customer_id""")),
    "grouped_quantiles_null_group": (grouped_quantiles_null_group, with_ctes(
        " UNION ALL ".join(
            f"""SELECT CASE WHEN year(transaction_date) % 3 <> 0 THEN year(transaction_date) END AS year, CAST({p} AS DOUBLE) AS prob,
                round(quantile_cont(transaction_amount, {p}), 4) AS quantile FROM transactions GROUP BY 1"""
            for p in (0.1, 0.5, 1.0)))),
    "one_class_metrics": (one_class_metrics, with_ctes(
        ranking_sql("churned"), **BASE, churned="SELECT * FROM scored WHERE churn = 1")),
    "candidate_metrics": (candidate_metrics, with_ctes(
        "SELECT * FROM candidate_ranking JOIN candidate_confusion USING (model_type)", **CANDIDATE_CTES)),
    "candidate_comparison": (candidate_comparison, with_ctes(
        """SELECT 'churn_model' AS model_name, max(model_type) FILTER (place = 1) AS winner,
           max(roc_auc) FILTER (place = 1) AS winner_roc_auc, max(roc_auc) FILTER (place = 2) AS runner_up_roc_auc,
           round(max(roc_auc) FILTER (place = 1) - max(roc_auc) FILTER (place = 2), 4) AS roc_auc_margin
           FROM (SELECT model_type, roc_auc, row_number() OVER (ORDER BY roc_auc DESC) AS place
                 FROM candidate_ranking)""", **CANDIDATE_CTES)),
    "amount_quantiles": (amount_quantiles, with_ctes(
        " UNION ALL ".join(
            f"""SELECT year(transaction_date) AS year, CAST({p} AS DOUBLE) AS prob,
                round(quantile_cont(transaction_amount, {p}), 4) AS quantile FROM transactions GROUP BY 1"""
            for p in (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)))),
}
