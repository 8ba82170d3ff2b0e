"""Models as expressions, and the certificate of a logistic fit."""
from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitf.operators import scorecard as sc
from pitf.operators.model import GRADIENT_BOOSTING, LOGISTIC, ModelPolicy, build_pipeline, score
from pitf.session import prepare

NAMES = ("steady", "skewed", "constant")
POLICY = ModelPolicy(n_estimators=12, max_depth=4)


@pytest.fixture(scope="module")
def spark(spark):
    """This module's own session: after an observation here the other modules' fitted models would not score."""
    return prepare(spark.newSession())


@pytest.fixture(scope="module")
def people(spark):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(900):
        steady, skewed = float(rng.normal()), float(rng.lognormal(3, 2))
        odds = 1.3 * steady - 0.4 * math.log(skewed) + 1
        rows.append((i, steady, skewed, 7.0, int(rng.random() < 1 / (1 + math.exp(-odds))), 0.5 + i % 3))
    return spark.createDataFrame(rows, "customer_id INT, steady DOUBLE, skewed DOUBLE, constant DOUBLE, churn INT, weight DOUBLE")


@pytest.mark.parametrize("kind", [GRADIENT_BOOSTING, LOGISTIC])
def test_expression_equals_the_transformer(people, kind):
    model = build_pipeline(kind, POLICY, 900, NAMES).fit(people)
    rows = score(model, people.withColumn("own", sc.score_expression(model)), keep=("own",)).collect()
    assert len(rows) == 900 and len({round(r["own"], 6) for r in rows}) > 50
    assert max(abs(r["own"] - r["churn_score"]) for r in rows) < 1e-9


def test_values_on_a_split_and_nan_go_the_way_the_model_sends_them(spark, people):
    model = build_pipeline(GRADIENT_BOOSTING, POLICY, 900, NAMES).fit(people)
    bounds = [float(line.split("<= ")[1].rstrip(")")) for tree in model.stages[-1].trees
              for line in tree.toDebugString.splitlines() if "feature 0 <=" in line]
    edge = spark.createDataFrame([(0, v, 20.0, 7.0) for v in [*bounds, math.nan, math.inf, -math.inf]],
                                 "customer_id INT, steady DOUBLE, skewed DOUBLE, constant DOUBLE")
    # The assembler refuses NaN unless told to keep it.
    model.stages[0].setHandleInvalid("keep")
    for r in score(model, edge.withColumn("own", sc.score_expression(model)), keep=("own",)).collect():
        assert r["own"] == pytest.approx(r["churn_score"], abs=1e-12)


def test_single_leaf_and_unknown_models(spark):
    lone = spark.range(1).select(sc.tree_expression("Tree\n  Predict: -0.25", []).alias("x")).first()
    assert lone["x"] == -0.25
    with pytest.raises(ValueError):
        sc.tree_expression("If (feature 0 <= 1.0)\n Predict: 2.0", [F.lit(1.0)])


def test_certificate_is_small_at_the_optimum_only(people):
    fitted = build_pipeline(LOGISTIC, POLICY, 900, NAMES).fit(people)
    proof = sc.logistic_certificate(fitted, people).first()
    positives = people.where("churn = 1").count()
    assert (proof["rows"], proof["positives"]) == (900, positives) and proof["base_rate"] == pytest.approx(positives / 900)
    assert proof["gradient_norm"] < 1e-4
    hasty = build_pipeline(LOGISTIC, POLICY, 900, NAMES)
    hasty.getStages()[-1].setMaxIter(1)
    assert sc.logistic_certificate(hasty.fit(people), people).first()["gradient_norm"] > 1e-3


def test_certificate_equals_a_gradient_by_hand(people):
    fitted = build_pipeline(LOGISTIC, POLICY, 40, NAMES).fit(people)
    part = people.where("customer_id < 200")
    table = part.toPandas()
    scaler, model = fitted.stages[1], fitted.stages[2]
    spread = np.array(scaler.std)
    x = np.where(spread > 0, (table[list(NAMES)].to_numpy() - np.array(scaler.mean)) / np.where(spread > 0, spread, 1), 0)
    p = 1 / (1 + np.exp(-(x @ model.coefficients.toArray() + model.intercept)))
    pull = table["weight"].to_numpy() * (p - table["churn"].to_numpy())
    slopes = [pull.sum(), *(pull @ x)] / table["weight"].sum() + np.array([0, *model.coefficients.toArray() / 40])
    assert sc.logistic_certificate(fitted, part).first()["gradient_norm"] == pytest.approx(np.linalg.norm(slopes))
    assert sc.logistic_certificate(fitted, part.where("false")).first()["gradient_norm"] is None


def test_a_logistic_model_scores_after_an_observation_in_its_session(spark, people):
    from pyspark.sql import Observation

    seen = Observation("rows before fitting")
    spark.range(10).observe(seen, F.count(F.lit(1)).alias("rows")).collect()
    assert seen.get["rows"] == 10
    model = build_pipeline(LOGISTIC, POLICY, 900, NAMES).fit(people)
    assert model.stages[-1].hasSummary
    rows = score(model, people, keep=("customer_id",)).collect()
    assert len(rows) == 900 and all(0 <= r["churn_score"] <= 1 for r in rows)
