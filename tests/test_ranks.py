"""Running totals, quantiles and classifier metrics against brute force."""
from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitf.operators import metrics as mt
from pitf.operators import quantiles
from pitf.operators import split as sp
from pitf.operators.prefix import running_totals
from pitf.operators.quantiles import discrete_quantile, exact_quantiles


def test_running_totals_with_a_dominant_group(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["hot"] * 8 + ["b", None]), i, rng.randint(0, 9)) for i in range(2000)]
    df = spark.createDataFrame(rows, "g STRING, id INT, x BIGINT").repartition(7)
    got = running_totals(df, [("id", False)], {"s": F.col("x"), "n": F.lit(1)}, ["g"])
    expected, totals = {}, {}
    for g, i, x in sorted(rows, key=lambda r: -r[1]):
        s, n = totals.get(g, (0, 0))
        totals[g] = expected[i] = (s + x, n + 1)
    assert {r["id"]: (r["s_cum"], r["n_cum"]) for r in got.collect()} == expected
    assert {(r["g"], r["s_total"], r["n_total"]) for r in got.collect()} == {(g, *t) for g, t in totals.items()}


def test_the_dominant_group_is_spread_over_tasks(spark, monkeypatch):
    from pitf.operators import prefix

    written = []
    keep = prefix.materialise
    monkeypatch.setattr(prefix, "materialise", lambda df, name: written.append(keep(df, name)) or written[-1])
    df = spark.range(4000).select(F.lit("hot").alias("g"), "id")
    running_totals(df, [("id", True)], {"n": F.lit(1)}, ["g"])
    sizes = [r["count"] for r in written[0].groupBy("_slice").count().collect()]
    assert len(sizes) == 3 and max(sizes) < 2400


@pytest.mark.parametrize("n", [1, 2, 3, 10, 9_999, 10_000, 10_001, 40_007])
def test_quantiles_match_linear_interpolation(spark, n):
    values = np.random.default_rng(n).integers(0, 3 * n, n) ** 1.5
    values[: n // 3] = 4.0
    probs = [0.0, 0.0003, 0.1, 0.25, 0.5, 0.77, 0.9998, 1.0]
    df = spark.createDataFrame([(float(v),) for v in values], "x DOUBLE")
    got = {r["prob"]: r["quantile"] for r in exact_quantiles(df, "x", probs).collect()}
    assert got == pytest.approx({p: np.quantile(values, p) for p in probs})


def test_poor_brackets_are_widened(spark, monkeypatch):
    """With first guesses beside the mark the answer is still exact."""
    from pitf.operators import quantiles

    guess = quantiles.F.percentile_approx
    monkeypatch.setattr(quantiles.F, "percentile_approx", lambda c, ps, acc: guess(c, [p * 0.97 for p in ps], acc))
    df = spark.range(30_000).select((F.col("id") * 1.0).alias("x"))
    got = {r["prob"]: r["quantile"] for r in exact_quantiles(df, "x", [0.25, 0.9]).collect()}
    assert got == pytest.approx({p: np.quantile(np.arange(30_000), p) for p in (0.25, 0.9)})


def test_quantiles_per_group_skip_nulls(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", None), ("b", 5.0), (None, 7.0)], "g STRING, x DOUBLE")
    got = {r["g"]: r["quantile"] for r in exact_quantiles(df.where("g IS NOT NULL"), "x", [0.5], ["g"]).collect()}
    assert got == {"a": 1.5, "b": 5.0}


@pytest.mark.parametrize(("q", "expected"), [(0.1, 1), (0.15, 2), (0.25, 3), (0.5, 5), (1.0, 10)])
def test_discrete_quantile_returns_an_element(spark, q, expected):
    df = spark.range(1, 11)
    assert discrete_quantile(df, F.col("id"), q).first()["value"] == expected


def scored(spark, rows):
    return spark.createDataFrame(rows, "customer_id INT, churn INT, churn_score DOUBLE")


def by_hand(rows, top=0.10):
    y = np.array([r[1] for r in rows])
    s = np.array([r[2] for r in rows])
    pos, neg = s[y == 1], s[y == 0]
    auc = np.mean([(p > neg).mean() + (p == neg).mean() / 2 for p in pos])
    ap = np.mean([y[s >= p].mean() for p in pos])
    n = max(1, int(len(rows) * top))
    best = sorted(rows, key=lambda r: (-r[2], -r[0]))[:n]
    return auc, ap, np.mean([r[1] for r in best])


@pytest.mark.parametrize("levels", [3, 50, 100_000])
def test_ranking_metrics_with_ties(spark, levels):
    rng = random.Random(levels)
    rows = [(i, int(rng.random() < 0.3), rng.randint(0, levels) / levels) for i in range(700)]
    row = mt.ranking_metrics(scored(spark, rows)).first()
    auc, ap, top = by_hand(rows)
    assert (row["roc_auc"], row["average_precision"], row["precision_at_decile"]) == pytest.approx((auc, ap, top))
    assert row["ap_lift_over_base"] == pytest.approx(ap / row["base_rate"])


@pytest.mark.parametrize("label", [0, 1])
def test_one_class_gives_zero(spark, label):
    row = mt.ranking_metrics(scored(spark, [(i, label, i / 9) for i in range(9)])).first()
    assert (row["roc_auc"], row["average_precision"], row["ap_lift_over_base"]) == (0, 0, 0)


def test_confusion_metrics(spark):
    rows = [(1, 1, 0.9), (2, 1, 0.5), (3, 1, 0.2), (4, 0, 0.6), (5, 0, 0.1)]
    row = mt.confusion_metrics(scored(spark, rows)).first()
    assert tuple(row) == pytest.approx((2 / 3, 2 / 3, 3 / 5))
    nobody = mt.confusion_metrics(scored(spark, [(1, 0, 0.1)])).first()
    assert (nobody["precision"], nobody["recall"]) == (0, 0)


def test_classifier_metrics_keep_groups_apart(spark):
    rng = random.Random(5)
    rows = [(i, int(rng.random() < 0.4), rng.random()) for i in range(300)]
    one = scored(spark, rows).withColumn("model_type", F.lit("a"))
    two = one.withColumn("model_type", F.lit("b")).withColumn("churn_score", 1 - F.col("churn_score"))
    both = {r["model_type"]: r["roc_auc"] for r in mt.classifier_metrics(one.union(two), ["model_type"]).collect()}
    assert both["a"] == pytest.approx(by_hand(rows)[0]) and both["a"] + both["b"] == pytest.approx(1)


def test_split_is_order_free_and_near_the_share(spark):
    ids = spark.range(5000).withColumnRenamed("id", "customer_id")
    flag = sp.is_test(F.col("customer_id"), 0.2, 42)
    picked = {r[0] for r in ids.where(flag).collect()}
    assert picked == {r[0] for r in ids.repartition(9).where(flag).collect()}
    assert 0.18 < len(picked) / 5000 < 0.22
    assert picked != {r[0] for r in ids.where(sp.is_test(F.col("customer_id"), 0.2, 7)).collect()}


def test_stratified_split_is_exact_per_class(spark):
    df = spark.range(1000).select(F.col("id").alias("customer_id"), (F.col("id") % 5 == 0).cast("int").alias("churn"))
    counts = sp.stratified_test_flags(df).where("is_test").groupBy("churn").count().collect()
    assert {tuple(r) for r in counts} == {(0, 160), (1, 40)}


def test_class_weights_balance(spark):
    df = spark.createDataFrame([(i, int(i < 2)) for i in range(10)], "customer_id INT, churn INT")
    weighted = sp.with_class_weight(df).groupBy("churn").agg(F.sum("weight").alias("w")).collect()
    assert {r["churn"]: r["w"] for r in weighted} == pytest.approx({0: 5.0, 1: 5.0})


def test_fingerprint_follows_rows_settings_and_content(spark):
    df = spark.createDataFrame([(1, 0), (2, 1)], "customer_id INT, churn INT")

    def fp(frame, **settings):
        return sp.input_fingerprint(frame, settings or {"a": "1"}, content=frame.columns).first()["fingerprint"]

    swapped = spark.createDataFrame([(1, 1), (2, 0)], "customer_id INT, churn INT")
    assert fp(df) == fp(df.orderBy(F.desc("customer_id")))
    assert len({fp(df), fp(df, a="2"), fp(swapped), fp(df.where("churn = 1"))}) == 4
    empty = sp.input_fingerprint(df.where("false"), {"a": "1"}).first()
    assert (empty["rows"], empty["churn_mean"]) == (0, 0.0)


def test_columns_share_passes_and_equal_one_column_at_a_time(spark):
    rng = np.random.default_rng(8)
    values = {"skewed": rng.random(3000) ** 9, "few": rng.integers(0, 3, 3000).astype(float), "same": np.full(3000, 2.5),
              "sparse": np.where(rng.random(3000) < 0.99, np.nan, rng.random(3000))}
    rows = [tuple(None if np.isnan(v) else float(v) for v in row) for row in zip(*values.values())]
    df = spark.createDataFrame([(*r, None) for r in rows], ", ".join(f"{c} DOUBLE" for c in values) + ", empty DOUBLE")
    probs = [0.0, 0.1, 0.5, 0.77, 1.0]
    got = {(r["feature"], r["prob"]): r["quantile"] for r in quantiles.column_quantiles(df, [*values, "empty"], probs).collect()}
    want = {(c, p): np.quantile(v[~np.isnan(v)], p) for c, v in values.items() for p in probs}
    assert got == {k: pytest.approx(v) for k, v in want.items()}
    assert quantiles.column_quantiles(df.limit(0), list(values), probs).collect() == []


def test_only_missed_groups_go_round_again(spark, monkeypatch):
    """With brackets far too coarse, ranks fall outside; the answer stays exact, group by group."""
    monkeypatch.setattr(quantiles, "ACCURACY", 50)
    rng = np.random.default_rng(4)
    groups = {"large": rng.random(4000), "tiny": rng.random(3), None: rng.random(700)}
    df = spark.createDataFrame([(g, float(v)) for g, x in groups.items() for v in x], "g STRING, v DOUBLE")
    seen = []
    whole = quantiles._ranked_hits

    def watched(rows, probs, by, slack):
        seen.append({r["g"]: r["count"] for r in rows.groupBy("g").count().collect()})
        return whole(rows, probs, by, slack)

    monkeypatch.setattr(quantiles, "_ranked_hits", watched)
    monkeypatch.setattr(quantiles, "_with_brackets", narrowed(quantiles._with_brackets))
    got = {(r["g"], r["prob"]): r["quantile"] for r in quantiles.exact_quantiles(df, "v", [0.25, 0.5], ["g"]).collect()}
    assert got == {(g, p): pytest.approx(np.quantile(x, p)) for g, x in groups.items() for p in (0.25, 0.5)}
    assert set(seen[0]) == set(groups) and set(seen[1]) == {"tiny"}


def narrowed(with_brackets):
    """Brackets of the group ``tiny`` that hold nothing, in the first round."""
    rounds = []

    def run(rows, probs, groups, slack):
        bracketed, low, high = with_brackets(rows, probs, groups, slack)
        rounds.append(slack)
        if len(rounds) > 1:
            return bracketed, low, high
        tiny = F.col("g") == "tiny"
        return (bracketed, [F.when(tiny.eqNullSafe(True), F.lit(-2.0)).otherwise(c) for c in low],
                [F.when(tiny.eqNullSafe(True), F.lit(-1.0)).otherwise(c) for c in high])
    return run
