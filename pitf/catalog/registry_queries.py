"""Registry, gate and alias operators over a registry of one model per supplier."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitf.catalog.common import as_bigint, rounded, with_ctes
from pitf.operators import registry as reg
from pitf.sources import sample_tables as st

COLUMNS = ["model_name", "version", "roc_auc", "ap_lift_over_base", "alias", "input_hash"]


def registry_history(spark: SparkSession, sf: str) -> DataFrame:
    """One version per supplier and shipping month; quality figures come from its
    discounts and taxes, every eleventh version lacks them, and four suppliers of
    five have a champion."""
    monthly = (st.load(spark, sf, "lineitem")
               .groupBy("l_suppkey", F.trunc("l_shipdate", "MM").alias("month"))
               .agg(F.round(F.lit(0.45) + F.avg("l_discount") * F.lit(4.0), 6).alias("auc"),
                    F.round(F.lit(1.0) + F.avg("l_tax") * F.lit(4.0), 6).alias("lift")))
    by_month = Window.partitionBy("l_suppkey").orderBy("month")
    versions = monthly.withColumns({"version": F.row_number().over(by_month),
                                    "n": F.count(F.lit(1)).over(Window.partitionBy("l_suppkey"))})
    key, version = F.col("l_suppkey"), F.col("version")
    name = F.concat(F.lit("supplier-"), key)
    measured = version % 11 != 0
    return versions.select(
        name.alias("model_name"), version,
        F.concat(F.lit("models/"), key, F.lit("/"), version).alias("model_path"),
        F.md5(F.concat_ws("|", key, version)).alias("run_id"),
        F.when(measured, F.col("auc")).alias("roc_auc"),
        F.when(measured, F.col("auc") / 2).alias("average_precision"),
        F.when(measured, F.col("lift")).alias("ap_lift_over_base"),
        F.date_format("month", "yyyy-MM-dd").alias("created_at"),
        F.when((key % 5 != 0) & (version == key % F.col("n") + 1), reg.CHAMPION).alias("alias"),
        F.md5(F.concat_ws("|", key, F.quarter("month"), F.year("month"))).alias("input_hash"),
    )


def _shown(df: DataFrame) -> DataFrame:
    return rounded(as_bigint(df))


def registry_latest(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(reg.latest(registry_history(spark, sf)).select(*COLUMNS))


def registry_champions(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(reg.by_alias(registry_history(spark, sf)).select(*COLUMNS))


def registry_by_input_hash(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(reg.by_input_hash(registry_history(spark, sf)).select(*COLUMNS))


def _additions(spark: SparkSession, sf: str) -> DataFrame:
    """One new version per supplier, also for those without a registry yet."""
    suppliers = st.load(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.min("l_discount").alias("low"))
    return suppliers.select(
        F.concat(F.lit("supplier-"), "l_suppkey").alias("model_name"),
        F.round(F.lit(0.6) + F.col("low"), 6).alias("roc_auc"), F.lit(1.2).alias("ap_lift_over_base"),
        F.lit(None).cast("string").alias("alias"), F.lit("new").alias("input_hash"),
    ).unionByName(suppliers.select(
        F.concat(F.lit("newcomer-"), "l_suppkey").alias("model_name"), F.lit(0.6).alias("roc_auc"),
        F.lit(1.2).alias("ap_lift_over_base"), F.lit(None).cast("string").alias("alias"),
        F.lit("new").alias("input_hash")))


def registry_next_versions(spark: SparkSession, sf: str) -> DataFrame:
    return as_bigint(reg.next_versions(registry_history(spark, sf), _additions(spark, sf)))


def registry_append(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(reg.append(registry_history(spark, sf), _additions(spark, sf)).select(*COLUMNS))


def gate_decisions(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(reg.evaluate_gate(registry_history(spark, sf)))


def registry_alias_move(spark: SparkSession, sf: str) -> DataFrame:
    """Champion moves to a supplier's best version where that lifts enough; champions elsewhere stay."""
    history = registry_history(spark, sf)
    best = Window.partitionBy("model_name").orderBy(F.desc_nulls_last("roc_auc"), "version")
    targets = (history.withColumn("place", F.row_number().over(best)).where("place = 1")
               .where("ap_lift_over_base >= 1.17").select("model_name", "version"))
    return _shown(reg.move_alias(history, targets).select("model_name", "version", "alias"))


def registry_promoted(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(reg.promote(registry_history(spark, sf)).select("model_name", "version", "alias"))


CTES = {
    "monthly": """SELECT l_suppkey, date_trunc('month', l_shipdate) AS month,
        round(0.45::DOUBLE + avg(l_discount) * 4, 6) AS auc, round(1.0::DOUBLE + avg(l_tax) * 4, 6) AS lift
        FROM lineitem GROUP BY 1, 2""",
    "numbered": """SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY month) AS version,
        count(*) OVER (PARTITION BY l_suppkey) AS n FROM monthly""",
    "registry": """SELECT 'supplier-' || l_suppkey AS model_name, l_suppkey, version,
        CASE WHEN version % 11 <> 0 THEN auc END AS roc_auc,
        CASE WHEN version % 11 <> 0 THEN lift END AS ap_lift_over_base,
        CASE WHEN l_suppkey % 5 <> 0 AND version = l_suppkey % n + 1 THEN 'champion' END AS alias,
        md5(l_suppkey || '|' || quarter(month) || '|' || year(month)) AS input_hash FROM numbered""",
    "newest": """SELECT * FROM registry r WHERE version = (SELECT max(version) FROM registry x
        WHERE x.model_name = r.model_name)""",
    "gate_in": """SELECT n.*, CASE WHEN c.version <> n.version THEN c.roc_auc END AS champion_roc_auc
        FROM newest n LEFT JOIN (SELECT * FROM registry WHERE alias = 'champion') c USING (model_name)""",
    "gate_broken": """SELECT *, concat_ws('+',
        CASE WHEN roc_auc IS NULL OR ap_lift_over_base IS NULL THEN 'metric_missing' END,
        CASE WHEN roc_auc < 0.58 THEN 'auc_low' END, CASE WHEN ap_lift_over_base < 1.10 THEN 'lift_low' END,
        CASE WHEN champion_roc_auc - roc_auc > 0.02 THEN 'auc_below_champion' END) AS broken FROM gate_in""",
    "gate": """SELECT model_name, version, roc_auc, ap_lift_over_base, champion_roc_auc, broken = '' AS promote,
        CASE broken WHEN '' THEN 'passed' ELSE broken END AS reason FROM gate_broken""",
    "additions": """SELECT 'supplier-' || l_suppkey AS model_name, round(0.6::DOUBLE + min(l_discount), 6) AS roc_auc
        FROM lineitem GROUP BY l_suppkey
        UNION ALL SELECT DISTINCT 'newcomer-' || l_suppkey, 0.6::DOUBLE FROM lineitem""",
    "next_versions": """SELECT a.*, coalesce((SELECT max(version) FROM registry r WHERE r.model_name = a.model_name), 0) + 1
        AS next_version FROM additions a""",
}
LIST = ", ".join(COLUMNS)


def alias_sql(targets: str) -> str:
    return f"""SELECT model_name, version, CASE
        WHEN model_name || '#' || version IN (SELECT model_name || '#' || version FROM ({targets})) THEN 'champion'
        WHEN alias = 'champion' AND model_name IN (SELECT model_name FROM ({targets})) THEN NULL
        ELSE alias END AS alias FROM registry"""


QUERIES = {
    "registry_latest": (registry_latest, with_ctes(f"SELECT {LIST} FROM newest", **CTES)),
    "registry_champions": (registry_champions, with_ctes(
        f"SELECT {LIST} FROM registry WHERE alias = 'champion'", **CTES)),
    "registry_by_input_hash": (registry_by_input_hash, with_ctes(
        f"""SELECT {LIST} FROM (SELECT *, row_number() OVER (PARTITION BY model_name, input_hash
            ORDER BY version DESC) AS place FROM registry) WHERE place = 1""", **CTES)),
    "registry_next_versions": (registry_next_versions, with_ctes(
        "SELECT model_name, next_version FROM next_versions", **CTES)),
    "registry_append": (registry_append, with_ctes(
        f"""SELECT {LIST} FROM registry UNION ALL
            SELECT model_name, next_version, roc_auc, 1.2::DOUBLE, NULL, 'new' FROM next_versions""", **CTES)),
    "gate_decisions": (gate_decisions, with_ctes("SELECT * FROM gate", **CTES)),
    "registry_alias_move": (registry_alias_move, with_ctes(alias_sql(
        """SELECT model_name, version FROM (SELECT *, row_number() OVER (PARTITION BY model_name
           ORDER BY roc_auc DESC NULLS LAST, version) AS place FROM registry) WHERE place = 1 AND ap_lift_over_base >= 1.17"""),
        **CTES)),
    "registry_promoted": (registry_promoted, with_ctes(alias_sql("SELECT model_name, version FROM gate WHERE promote"),
                                                       **CTES)),
}
