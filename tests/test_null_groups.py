"""NULL groups, repeated customers, rows without a label, unfinished registry writes."""
from __future__ import annotations

import pytest
from conftest import CRM, CUSTOMERS, ENROLLMENTS, ts, tx_frame
from pyspark.sql import functions as F

from pitf.operators import drift, metrics, quantiles, registry, split
from pitf.operators.features import feature_snapshot
from pitf.sources import raw


def test_null_group_keeps_its_row(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0), (None, 9.0), (None, 11.0)], "g STRING, v DOUBLE")
    found = {(r["g"], r["prob"]): r[-1] for r in quantiles.exact_quantiles(rows, "v", [0.5], ["g"]).collect()}
    assert found == {("a", 0.5): 2.0, (None, 0.5): 9.0}
    assert {r["g"] for r in drift.psi(rows, rows, "v", groups=["g"]).collect()} == {"a", None}


def test_null_model_keeps_its_metrics(spark):
    rows = spark.createDataFrame([(m, i, float(i) / 9, i % 2) for m in ("x", None) for i in range(8)],
                                 "m STRING, customer_id INT, churn_score DOUBLE, churn INT")
    assert {r["m"] for r in metrics.classifier_metrics(rows, ["m"]).collect()} == {"x", None}


def test_null_label_is_refused(spark):
    rows = spark.createDataFrame([(1, 0), (2, None)], "customer_id INT, churn INT")
    with pytest.raises(Exception, match="NULL in churn"):
        split.with_class_weight(rows).collect()


def test_small_share_is_not_empty(spark):
    ids = spark.range(2_000_000).select(split.is_test(F.col("id"), 1e-5).alias("t"))
    assert 1 <= ids.where("t").count() <= 60


def test_repeated_customer_is_refused(spark):
    day = ts("1991-04-05")
    twice = spark.createDataFrame([(4, "Male", day, day), (4, "Male", day, day)], CUSTOMERS)
    with pytest.raises(Exception, match="repeated customer_id: 4"):
        feature_snapshot(twice, spark.createDataFrame([], ENROLLMENTS), tx_frame(spark, []), spark.createDataFrame([], CRM),
                         "2024-07-01").collect()


def test_registry_survives_an_unfinished_write(spark, tmp_path):
    store = registry.RegistryStore(spark, str(tmp_path / "r"))
    empty = store.read()
    broken = empty.sparkSession.range(3).selectExpr("raise_error('lost') AS version")
    with pytest.raises(Exception, match="lost"):
        store.write(broken)
    assert store.read().isEmpty()
    assert [store.write(empty), store.write(store.read())] == [1, 2]


def test_promotion_goes_by_header_names(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / raw.RAW_FILES["crm"]).write_text(
        "customer_id|extra|interaction_date|interaction_id|interaction_type\n7|x|2024-05-06|1001|Chat\n")
    raw.promote(spark, str(folder), str(tmp_path / "typed"), ["crm"])
    row = raw.read_promoted(spark, str(tmp_path / "typed"), ["crm"])["crm"].first()
    assert (row["customer_id"], row["interaction_id"], row["interaction_type"]) == (7, 1001, "Chat")
    with pytest.raises(Exception):
        raw.read_raw_table(spark, str(folder), "crm").collect()
