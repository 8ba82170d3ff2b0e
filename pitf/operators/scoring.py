"""Predictions: stamped score rows and the newest score per customer."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitf.functions.scalars import stamp

# Prediction columns and their order.
PREDICTION_COLUMNS = ["customer_id", "churn_score", "model_version", "scored_at", "scored_date"]
BASELINE_SCHEMA = "score DOUBLE, model_version STRING"


def stamp_predictions(scored: DataFrame, model_version: str, scored_at: str, scored_date: str) -> DataFrame:
    stamped = stamp(scored, model_version=model_version, scored_at=scored_at, scored_date=scored_date)
    return stamped.select(*PREDICTION_COLUMNS)


def latest_predictions(predictions: DataFrame) -> DataFrame:
    """Newest prediction of every customer."""
    newest = Window.partitionBy("customer_id").orderBy(F.desc("scored_date"), F.desc("scored_at"))
    return predictions.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def prediction_for(predictions: DataFrame, customer_id: int) -> DataFrame:
    """Newest prediction of one customer; the id is bound as a parameter, not spliced in."""
    return predictions.sparkSession.sql(
        "SELECT customer_id, churn_score, model_version, scored_at, scored_date FROM {predictions} "
        "WHERE customer_id = :cid ORDER BY scored_date DESC, scored_at DESC LIMIT 1",
        args={"cid": customer_id}, predictions=predictions)


def scoring_population(features: DataFrame) -> DataFrame:
    """Customers whose scores are monitored: those with past transactions."""
    return features.where("txn_count >= 1")
