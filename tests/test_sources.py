from __future__ import annotations

from datetime import date, datetime

import pytest
from conftest import tx_frame
from pyspark.sql import functions as F

from pitf.operators.features import feature_snapshot
from pitf.operators.scoring import latest_predictions, prediction_for
from pitf.session import materialise, scratch_path, shared_root
from pitf.sources import raw, tables

FILES = {
    "customers": ["customer_id|first_name|last_name|email|mobile|gender|date_of_birth|signup_date",
                  "1|a|b|c|d|Female|1990-01-01|2024-01-01", "2|a|b|c|d|Male|unknown|", "x|a|b|c|d|Male|1990-01-01|2024-01-01"],
    "enrollments": ["product_id|customer_id|product_type|enrollment_date|limit",
                    "10|1|Savings|2024-01-05|0.0", "11|1|Credit Card|never|none"],
    "transactions": ["product_id|customer_id|transaction_amount|closing_balance|transaction_date|transaction_id",
                     "1|1|10.5|10.5|2025-01-15 10:30:00|1", "1|1|5|15.5||2", "1|1|5|15.5|2025-01-15|3",
                     "1|1|abc|15.5|2025-01-16 00:00:00|4"],
    "crm": ["interaction_id|customer_id|interaction_type|interaction_date",
            "1|1|Chat|2025-02-25", "2|1|Email|2025-02-25 10:00:00", "3|1|Call|2025-2-5"],
}


@pytest.fixture(scope="module")
def raw_dir(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    for key, lines in FILES.items():
        (root / raw.RAW_FILES[key]).write_text("\n".join(lines) + "\n")
    return str(root)


def test_unreadable_values_become_null_and_useless_events_go(spark, raw_dir):
    got = raw.read_raw(spark, raw_dir)
    people = got["customers"].select("customer_id", "date_of_birth", "signup_date").collect()
    assert [tuple(r) for r in people] == [
        (1, datetime(1990, 1, 1), datetime(2024, 1, 1)), (2, None, None), (None, datetime(1990, 1, 1), datetime(2024, 1, 1))]
    assert [tuple(r) for r in got["enrollments"].select("limit", "enrollment_date").collect()] == [
        (0.0, datetime(2024, 1, 5)), (None, None)]
    assert [(r["transaction_id"], r["transaction_amount"]) for r in got["transactions"].collect()] == [(1, 10.5), (4, None)]
    assert [r["interaction_id"] for r in got["crm"].collect()] == [1]


def test_promotion_types_every_column(spark, raw_dir, tmp_path):
    paths = raw.promote(spark, raw_dir, str(tmp_path))
    typed = {k: tables.read_table(spark, p) for k, p in paths.items()}
    assert all(df.dtypes == [(f.name, f.dataType.simpleString()) for f in raw.table_schema(k)] for k, df in typed.items())
    assert typed["customers"].where("customer_id = 1").first()["date_of_birth"] == date(1990, 1, 1)
    assert {r["table"]: r["row_count"] for r in raw.row_counts(typed).collect()} == {
        "customers": 3, "enrollments": 2, "transactions": 4, "crm": 3}
    assert {r["table"]: r["column_count"] for r in raw.shape_report(typed).collect()}["crm"] == 4


def test_promoted_tables_give_the_same_features(spark, tmp_path):
    unreadable = ("x|", "11|", "1|1|5|", "1|1|abc", "2|1|Email", "3|1|Call")
    for key, lines in FILES.items():
        good = [line for line in lines if not line.startswith(unreadable)]
        (tmp_path / raw.RAW_FILES[key]).write_text("\n".join(good) + "\n")
    raw.promote(spark, str(tmp_path), str(tmp_path / "typed"))
    typed, text = raw.read_promoted(spark, str(tmp_path / "typed")), raw.read_raw(spark, str(tmp_path))
    rows = [feature_snapshot(*[t[n] for n in ("customers", "enrollments", "transactions", "crm")], "2025-03-01")
            .orderBy("customer_id").collect() for t in (typed, text)]
    assert rows[0] == rows[1] and [r["crm_count"] for r in rows[0]] == [1, 0]
    early = typed["enrollments"].where(F.col("enrollment_date") < F.lit("2025-03-01").cast("timestamp"))
    assert "LessThan(enrollment_date" in early._jdf.queryExecution().executedPlan().toString()


def test_a_load_reports_rows_and_unreadable_fields(spark, tmp_path):
    header = "note|" + "|".join(reversed(raw.table_schema("transactions").names))
    lines = ["n|1|2025-01-02 03:04:05|1.5|2.5|7|1", "n|2|someday|much|2.5|7|1", "n|x||1e3|-|8|1", "n|4|2025-01-03|||9|1"]
    (tmp_path / raw.RAW_FILES["transactions"]).write_text("\n".join([header, *lines]) + "\n")
    paths, audit = raw.promote_audited(spark, str(tmp_path), str(tmp_path / "typed"), ["transactions"])
    assert {(r["table"], r["row_count"]) for r in audit.collect()} == {("transactions", 4)}
    lost = {r["field"]: r["failed"] for r in raw.load_failures(audit).collect()}
    assert lost == {"transaction_id": 1, "transaction_date": 1, "closing_balance": 1, "transaction_amount": 1}
    written = spark.read.parquet(paths["transactions"])
    assert written.count() == 4 and "note" not in written.columns
    (tmp_path / raw.RAW_FILES["transactions"]).write_text(header + "\n")
    _, nothing = raw.promote_audited(spark, str(tmp_path), str(tmp_path / "typed"), ["transactions"])
    assert nothing.first()["row_count"] == 0 and raw.load_failures(nothing).collect() == []


def test_mixed_dates(spark):
    texts = ["2025-01-02", "2025-01-02 03:04:05", "2025-01-02T03:04:05", "2025/01/02", "02.01.2025", "soon", None]
    parsed = raw.parse_mixed_dates(spark.createDataFrame([(t,) for t in texts], "d STRING"), "d").collect()
    midnight, later = datetime(2025, 1, 2), datetime(2025, 1, 2, 3, 4, 5)
    assert [r["d"] for r in parsed] == [midnight, later, later, midnight, midnight, None, None]


def test_rewriting_one_partition_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = spark.createDataFrame([(1, "a", "x"), (2, "b", "x")], "id INT, day STRING, v STRING")
    tables.write_table(rows, path, partition_by="day")
    tables.write_table(rows.where("day = 'b'").withColumn("v", F.lit("y")), path, partition_by="day")
    assert sorted((r["id"], r["v"]) for r in tables.read_table(spark, path).collect()) == [(1, "x"), (2, "y")]
    tables.write_table(rows.where("id = 1"), path)
    assert tables.read_table(spark, path).count() == 1


def test_added_column_is_null_in_old_partitions(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = spark.createDataFrame([(1, "a")], "id INT, day STRING")
    tables.write_table(rows, path, partition_by="day")
    tables.write_table(rows.select("id", F.lit("b").alias("day"), F.lit(9).alias("extra")), path, partition_by="day")
    merged = tables.read_table(spark, path, merge_schema=True)
    assert sorted((r["day"], r["extra"]) for r in merged.collect()) == [("a", None), ("b", 9)]


def test_existence_and_conforming(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not tables.table_exists(spark, path)
    tables.write_table(spark.range(1), path)
    assert tables.table_exists(spark, path)
    shaped = tables.conform(spark.range(1), "alias STRING, id INT")
    assert shaped.dtypes == [("alias", "string"), ("id", "int")] and shaped.first()["alias"] is None
    assert tables.typed_rows(spark, [(None,)], "a DOUBLE").dtypes == [("a", "double")]


def test_shared_folder_comes_from_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    kept = materialise(tx_frame(spark, [(1, "2025-01-01")]), "kept")
    assert kept.count() == 1 and kept.inputFiles()[0].startswith("file:")


def test_latest_prediction(spark):
    rows = spark.createDataFrame(
        [(1, 0.1, "v1", "t", "2025-03-01"), (1, 0.2, "v1", "t", "2025-03-02"), (2, 0.3, "v1", "t", "2025-03-01")],
        "customer_id INT, churn_score DOUBLE, model_version STRING, scored_at STRING, scored_date STRING")
    assert {r["customer_id"]: r["churn_score"] for r in latest_predictions(rows).collect()} == {1: 0.2, 2: 0.3}
    assert prediction_for(rows, 1).first()["scored_date"] == "2025-03-02"
    assert prediction_for(rows, 99).collect() == []


def test_a_load_leaves_the_session_able_to_score_fitted_models(spark, tmp_path):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    header = "|".join(raw.table_schema("transactions").names)
    (tmp_path / raw.RAW_FILES["transactions"]).write_text(header + "\n1|2|1.5|2.5|2025-01-02|7\n")
    raw.promote_audited(spark, str(tmp_path), str(tmp_path / "typed"), ["transactions"])
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    rows = spark.createDataFrame([(float(x), x % 2) for x in range(8)], "x DOUBLE, label INT")
    rows = VectorAssembler(inputCols=["x"], outputCol="features").transform(rows)
    model = LogisticRegression(maxIter=5).fit(rows)
    assert model.hasSummary and len(model.transform(rows).select("probability", "prediction").collect()) == 8
