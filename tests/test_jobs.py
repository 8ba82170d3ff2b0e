"""The whole batch on synthetic customers whose recency tells whether they leave."""
from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pitf.operators.features import FEATURE_COLUMNS
from pitf.operators.model import ModelPolicy
from pitf.operators.registry import NOTHING_REGISTERED, GatePolicy
from pitf.operators.scoring import PREDICTION_COLUMNS
from pitf.plans import jobs
from pitf.sources.tables import write_table

N = 600
QUICK = ModelPolicy(n_estimators=5)


def draw(salt: str, *keys: str):
    """Uniform number in [0, 1) from the keys, the same on every run."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(salt), *keys)), 1, 8), 16, 10).cast("double") / 2**32


def synthetic(spark):
    ids = spark.range(1, N + 1).select(F.col("id").cast("int").alias("customer_id"))
    active = draw("active", "customer_id") < 0.65

    def events(day, amount, keep):
        return ids.where(keep).select("customer_id", day.cast("timestamp").alias("transaction_date"),
                                      amount.alias("transaction_amount"))

    def repeated(salt, low, high):
        times = (F.lit(low) + F.floor(draw(salt, "customer_id") * (high - low + 1))).cast("int")
        return ids.select("customer_id", F.explode(F.sequence(F.lit(1), times)).alias("i"))

    old = repeated("old", 3, 6).select(
        "customer_id",
        F.date_add(F.lit("2025-01-01").cast("date"), F.floor(draw("day", "customer_id", "i") * 14).cast("int"))
        .cast("timestamp").alias("transaction_date"),
        F.round(10 + 490 * draw("amount", "customer_id", "i"), 2).alias("transaction_amount"))
    recent = events(F.lit("2025-02-26 12:00:00"), F.lit(50.0), active)
    later = repeated("later", 1, 3).where(active).select(
        "customer_id",
        F.date_add(F.lit("2025-03-01").cast("date"), F.floor(draw("when", "customer_id", "i") * 58).cast("int"))
        .cast("timestamp").alias("transaction_date"), F.lit(40.0).alias("transaction_amount"))
    tx = old.unionByName(recent).unionByName(later).withColumns({
        "closing_balance": F.lit(100.0),
        "transaction_id": F.xxhash64("customer_id", "transaction_date", "transaction_amount")})
    day = F.lit("2024-01-05").cast("timestamp")
    enrolled = ids.select("customer_id", F.explode(F.when(
        draw("card", "customer_id") < 0.4, F.array(F.lit("Savings"), F.lit("Credit Card"))
    ).otherwise(F.array(F.lit("Savings")))).alias("product_type")).select(
        "customer_id", "product_type", F.hash("customer_id", "product_type").alias("product_id"),
        day.alias("enrollment_date"), F.when(F.col("product_type") == "Savings", 0.0).otherwise(5000.0).alias("limit"))
    return {
        "customers": ids.select(
            "customer_id", F.when(F.col("customer_id") % 2 == 0, "Female").otherwise("Male").alias("gender"),
            F.lit("1990-01-01").cast("timestamp").alias("date_of_birth"),
            F.lit("2024-01-01").cast("timestamp").alias("signup_date")),
        "enrollments": enrolled,
        "transactions": tx,
        "crm": ids.where(draw("chat", "customer_id") < 0.5).select(
            F.col("customer_id").cast("bigint").alias("interaction_id"), "customer_id",
            F.lit("Chat").alias("interaction_type"), F.lit("2025-02-10").cast("timestamp").alias("interaction_date")),
    }


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    ws = jobs.Workspace(str(tmp_path_factory.mktemp("ws")), model=QUICK)
    raw = synthetic(spark)
    assert jobs.drift_check(spark, ws, raw).first()["decision"] == "ok"
    assert jobs.promote(spark, ws, raw)["reason"] == NOTHING_REGISTERED
    with pytest.raises(LookupError):
        jobs.batch_score(spark, ws, raw, "2025-03-01")
    decision, table = jobs.materialize(raw, ws)
    trained = jobs.train(spark, ws, decision, table)
    promoted = jobs.promote(spark, ws, raw, as_of="2025-03-01")
    return ws, raw, decision, table, trained, promoted


def test_feature_table(run):
    _, _, decision, table, *_ = run
    assert decision["cutoff"] == "2025-03-01"
    assert table.columns == ["customer_id", "churn", *FEATURE_COLUMNS] and table.count() == N
    rate = jobs.label_rate(table).first()
    assert rate["rows"] == N and 0.25 < rate["churn_rate"] < 0.45


def test_training_finds_the_signal_and_promotes(run):
    *_, trained, promoted = run
    assert trained["roc_auc"] > 0.58 and trained["winning_model"] in QUICK.candidates and not trained["skipped"]
    assert promoted["promote"] and promoted["version"] == 1 and promoted["baseline_reset"]


def test_training_again_reuses_the_version(spark, run):
    ws, _, decision, table, trained, _ = run
    again = jobs.train(spark, ws, decision, table)
    assert again["skipped"] and again["version"] == trained["version"]
    assert ws.registry(spark).read().count() == 1


def test_batch_scores(spark, run):
    ws, raw, *_ = run
    scored = jobs.batch_score(spark, ws, raw, "2025-03-01")
    assert scored.columns == PREDICTION_COLUMNS and scored.count() == N
    assert scored.where("churn_score NOT BETWEEN 0 AND 1 OR churn_score IS NULL").count() == 0
    assert {r["model_version"] for r in scored.select("model_version").distinct().collect()} == {"churn_model v1"}


def test_drift_against_the_promoted_baseline(spark, run):
    ws, raw, *_ = run
    same = jobs.drift_check(spark, ws, raw, "2025-03-01").first()
    assert same["psi"] == pytest.approx(0, abs=1e-9) and same["decision"] == "ok"
    even = spark.range(500).select((F.col("id") / 500).alias("score"), F.lit("churn_model v0").alias("model_version"))
    write_table(even, ws.path("drift_baseline"))
    moved = jobs.drift_check(spark, ws, raw, "2025-03-01").first()
    assert moved["psi"] > 0.25 and moved["decision"] == "breach"


def test_rejected_version_leaves_the_champion(spark, run):
    from dataclasses import replace

    ws, raw, decision, table, *_ = run
    strict = replace(ws, gate=GatePolicy(min_roc_auc=1.01), model=replace(QUICK, random_state=7))
    assert jobs.train(spark, strict, decision, table)["version"] == 2
    verdict = jobs.promote(spark, strict, raw)
    assert not verdict["promote"] and verdict["reason"] == "auc_low"
    assert jobs.load_scorer(spark, ws).model_version == "churn_model v1"


def test_relative_definition_from_a_rolled_cutoff(run):
    _, raw, decision, *_ = run
    fields = decision.asDict() | {"definition": jobs.RELATIVE, "inactive_percentile": 0.5}
    from pyspark.sql import Row

    relative = jobs.label_rate(jobs.build_feature_table(raw, Row(**fields))).first()
    absolute = jobs.label_rate(jobs.build_feature_table(raw, decision)).first()
    assert relative["churn_rate"] > absolute["churn_rate"]
