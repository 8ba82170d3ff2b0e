from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitf.operators import drift as dr


def frame(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "score DOUBLE")


def by_hand(expected, actual, bins=10):
    edges = np.unique(np.quantile(expected, np.linspace(0, 1, bins + 1)))
    if len(edges) < 2:
        return 0.0
    where = [np.searchsorted(edges[1:-1], v, side="right") for v in (expected, actual)]
    e, a = [np.clip(np.bincount(w, minlength=len(edges) - 1) / len(w), 1e-6, None) for w in where]
    return float(((a - e) * np.log(a / e)).sum())


RNG = np.random.default_rng(3)
UNIFORM = RNG.random(900)


@pytest.mark.parametrize(("expected", "actual"), [
    (UNIFORM, UNIFORM),
    (UNIFORM, RNG.random(400) ** 2),
    (UNIFORM, np.full(50, 0.3)),
    (RNG.integers(0, 4, 500) / 4, RNG.integers(0, 5, 700) / 4),
    (np.r_[np.zeros(600), UNIFORM[:50]], UNIFORM),
    (np.full(20, 0.5), UNIFORM),
    (np.r_[np.zeros(50), np.ones(50)], UNIFORM),
])
def test_psi_matches_the_definition(spark, expected, actual):
    got = dr.psi(frame(spark, expected), frame(spark, actual), "score").first()["psi"]
    assert got == pytest.approx(by_hand(expected, actual), abs=1e-9)


def test_decision_is_strict_and_severity_has_three_bands(spark):
    rows = spark.createDataFrame([(v,) for v in (0.05, 0.1, 0.25, 0.2501)], "psi DOUBLE")
    shown = dr.drift_decision(rows.withColumn("severity", dr.severity(F.col("psi")))).orderBy("psi").collect()
    assert [r["decision"] for r in shown] == ["ok", "ok", "ok", "breach"]
    assert [r["severity"] for r in shown] == ["stable", "moderate", "moderate", "significant"]


def test_a_shift_breaches(spark):
    row = dr.drift_decision(dr.psi(frame(spark, UNIFORM), frame(spark, UNIFORM / 2 + 0.5), "score")).first()
    assert row["decision"] == "breach" and row["psi"] > 0.25


def test_feature_psi_matches_one_feature_at_a_time(spark):
    before = spark.createDataFrame([(float(a), float(b)) for a, b in RNG.random((300, 2))], "a DOUBLE, b DOUBLE")
    after = before.select((F.col("a") * 0.5).alias("a"), "b")
    got = {r["feature"]: r["psi"] for r in dr.feature_psi(before, after, ["a", "b"]).collect()}
    assert got["b"] == pytest.approx(0) and got["a"] == pytest.approx(dr.psi(before, after, "a").first()["psi"])
