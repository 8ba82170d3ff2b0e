"""Candidate classifiers on Spark ML and the scorer built from a fitted one."""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitf.operators.features import FEATURE_COLUMNS
from pitf.session import scratch_path

# The two model families, in order of preference on equal AUC.
GRADIENT_BOOSTING, LOGISTIC = "gradient_boosting", "logistic_regression"


@dataclass(frozen=True)
class ModelPolicy:
    """Candidates, hold-out share, seed and tree parameters."""

    candidates: tuple[str, ...] = (GRADIENT_BOOSTING, LOGISTIC)
    test_size: float = 0.2
    random_state: int = 42
    n_estimators: int = 100
    max_depth: int = 3
    learning_rate: float = 0.1


def build_pipeline(model_type: str, policy: ModelPolicy, train_rows: int,
                   features: Sequence[str] = tuple(FEATURE_COLUMNS)) -> Pipeline:
    """Unfitted pipeline; both families are trained with balanced class weights.

    A penalty strength of 1 per training set is 1/rows in Spark's averaged loss.
    """
    assembler = VectorAssembler(inputCols=list(features), outputCol="raw_features")
    if model_type == LOGISTIC:
        scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
        classifier = LogisticRegression(
            featuresCol="features", labelCol="churn", weightCol="weight", maxIter=1000,
            regParam=1.0 / max(1, train_rows), standardization=False)
        return Pipeline(stages=[assembler, scaler, classifier])
    if model_type == GRADIENT_BOOSTING:
        classifier = GBTClassifier(
            featuresCol="raw_features", labelCol="churn", weightCol="weight", maxIter=policy.n_estimators,
            maxDepth=policy.max_depth, stepSize=policy.learning_rate, seed=policy.random_state)
        return Pipeline(stages=[assembler, classifier])
    raise ValueError(f"unknown model type {model_type!r}")


def without_summary(model: PipelineModel, spark: SparkSession) -> PipelineModel:
    """The same fitted stages without a training summary.

    A logistic model's summary keeps the session it was trained in, and scoring ships the model to the tasks: once any
    observation ran in that session, Java can no longer serialize it. Written to the shared folder and read back, the
    model holds only its parameters and weights, so its scores are the same.
    """
    if not any(getattr(stage, "hasSummary", False) for stage in model.stages):
        return model
    path = scratch_path(spark, "model")
    model.write().save(path)
    return PipelineModel.load(path)


def score(model: PipelineModel, features: DataFrame, keep: Sequence[str] = ("customer_id",)) -> DataFrame:
    """(keep, churn_score): probability of churn, computed where the rows are."""
    return without_summary(model, features.sparkSession).transform(features).select(
        *keep, vector_to_array("probability")[1].alias("churn_score"))


@dataclass(frozen=True)
class Scorer:
    """A fitted model with the version label it stamps on its scores."""

    model: PipelineModel
    model_version: str

    def score(self, features: DataFrame) -> DataFrame:
        return score(self.model, features)

    def score_with_version(self, features: DataFrame) -> DataFrame:
        return self.score(features).withColumn("model_version", F.lit(self.model_version))
