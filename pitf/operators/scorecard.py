"""Fitted models as plain column expressions, and the optimality of a logistic fit as one aggregate.

An expression scores wherever its columns are, with no ML transformer, vector column or model file behind it.
"""
from __future__ import annotations

import re
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel
from pyspark.ml.feature import StandardScalerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TEST = re.compile(r"If \(feature (\d+) <= (\S+)\)")
_LEAF = re.compile(r"Predict: (\S+)")


def _total(terms: list[Column], start: float = 0.0) -> Column:
    """Sum as a balanced tree, so hundreds of terms nest a few levels deep."""
    terms = [F.lit(start), *terms]
    while len(terms) > 1:
        terms = [reduce(lambda x, y: x + y, terms[i:i + 2]) for i in range(0, len(terms), 2)]
    return terms[0]


def tree_expression(text: str, columns: list[Column]) -> Column:
    """Nested CASE of one regression tree, from its debug text.

    The text lists a test, the branch below it, an ``Else`` line, and the branch above it; a NaN goes the way of the
    larger values, as in the model.
    """
    lines = iter(text.splitlines())

    def branch() -> Column:
        for line in lines:
            if leaf := _LEAF.search(line):
                return F.lit(float(leaf[1]))
            if test := _TEST.search(line):
                below = branch()
                return F.when(columns[int(test[1])] <= F.lit(float(test[2])), below).otherwise(branch())
        raise ValueError("the text of the tree ends inside a branch")

    return branch()


def _inputs(model: PipelineModel) -> tuple[list[str], list[Column]]:
    """Names of the features and what the classifier sees of them."""
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    names = assembler.getInputCols()
    seen = [F.col(n).cast("double") for n in names]
    for scaler in (s for s in model.stages if isinstance(s, StandardScalerModel)):
        # A constant column has no spread; the scaler sets it to zero.
        seen = [(x - F.lit(float(mean))) / F.lit(float(std)) if std else F.lit(0.0)
                for x, mean, std in zip(seen, scaler.mean, scaler.std)]
    return names, seen


def margin(model: PipelineModel) -> Column:
    """Log odds of churn under a fitted pipeline."""
    _, seen = _inputs(model)
    fitted = model.stages[-1]
    if isinstance(fitted, LogisticRegressionModel):
        return _total([x * F.lit(float(b)) for x, b in zip(seen, fitted.coefficients)], float(fitted.intercept))
    if isinstance(fitted, GBTClassificationModel):
        # The boosted sum is half the log odds.
        return F.lit(2.0) * _total([tree_expression(t.toDebugString, seen) * F.lit(float(w))
                                    for t, w in zip(fitted.trees, fitted.treeWeights)])
    raise TypeError(f"no expression for {type(fitted).__name__}")


def score_expression(model: PipelineModel) -> Column:
    """Probability of churn as an expression over the feature columns."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin(model)))


def logistic_certificate(model: PipelineModel, training: DataFrame, label: str = "churn",
                         weight: str = "weight") -> DataFrame:
    """One row (rows, positives, base_rate, gradient_norm) of a logistic fit on the rows it was trained on.

    The gradient of the weighted mean log loss with its penalty, at the fitted weights, in one aggregation with one sum
    per feature. The loss is convex, so a norm near zero proves the fit, whatever the solver did. NULL without rows.
    """
    fitted = model.stages[-1]
    _, seen = _inputs(model)
    w = F.col(weight)
    residual = w * (score_expression(model) - F.col(label))
    pulls = training.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col(label)).cast("bigint").alias("positives"),
        F.avg(label).alias("base_rate"), F.sum(w).alias("_w"), F.sum(residual).alias("_0"),
        *[F.sum(residual * x).alias(f"_{j}") for j, x in enumerate(seen, 1)])
    penalty = fitted.getRegParam()
    slopes = [F.col("_0") / F.col("_w")] + [
        F.col(f"_{j}") / F.col("_w") + F.lit(penalty * float(b)) for j, b in enumerate(fitted.coefficients, 1)]
    return pulls.select("rows", "positives", "base_rate", F.sqrt(_total([s * s for s in slopes])).alias("gradient_norm"))
