"""Customer tables derived from the order-entry sample tables.

Orders act as transactions, line items as enrollments, events as interactions.
Timestamps are declared as instants, so filters on them reach the Parquet scan.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitf.operators.cutoff import LabelPolicy

# The sample orders run 1995-2001; a year is the window with a usable base rate.
SAMPLE_LABEL = LabelPolicy(cutoff_date="1998-03-01", window_days=365)
CUTOFF = SAMPLE_LABEL.cutoff_date
WINDOW = SAMPLE_LABEL.window_days
LATER_CUTOFF = "1999-03-01"
# Moves 2024-01-16 to the default cutoff, so interactions fall on both sides of it.
EVENT_SHIFT_DAYS = 9452

COLUMNS = {
    "customer": "c_custkey BIGINT, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, o_orderdate TIMESTAMP",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_extendedprice DOUBLE, "
                "l_discount DOUBLE, l_tax DOUBLE, l_shipdate TIMESTAMP",
    "part": "p_partkey BIGINT, p_type STRING",
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _start_plus(day: str, days: Column) -> Column:
    return F.date_add(F.lit(day).cast("date"), days.cast("int")).cast("timestamp")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return load(spark, sf_dir, "customer").select(
        key.alias("customer_id"),
        F.when(key % 4 == 0, "Female").when(key % 4 == 2, "FEMALE").otherwise("Male").alias("gender"),
        F.when(key % 50 != 0, _start_plus("1940-01-01", key * 37 % 14000)).alias("date_of_birth"),
        _start_plus("1994-01-01", key * 13 % 1800).alias("signup_date"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("transaction_amount"),
        F.col("o_totalprice").alias("closing_balance"),
        F.col("o_orderdate").alias("transaction_date"),
        F.col("o_orderkey").alias("transaction_id"),
    )


def enrollments(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", "l_shipdate")
    buyers = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    kind = F.col("p_type")
    return (items.join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(load(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
            .select(F.col("l_partkey").alias("product_id"), F.col("o_custkey").alias("customer_id"),
                    F.when(kind == "STANDARD", "Savings").when(kind == "PROMO", "Credit Card")
                    .otherwise(kind).alias("product_type"),
                    F.col("l_shipdate").alias("enrollment_date"), F.col("l_extendedprice").alias("limit")))


def crm(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return load(spark, sf_dir, "events").select(
        F.col("event_id").alias("interaction_id"), F.col("user_id").alias("customer_id"),
        F.when(kind == "click", "Chat").when(kind == "view", "Email").when(kind == "error", "Call")
        .otherwise(kind).alias("interaction_type"),
        (F.col("ts") - F.expr(f"INTERVAL {EVENT_SHIFT_DAYS} DAYS")).alias("interaction_date"),
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"customers": customers(spark, sf_dir), "enrollments": enrollments(spark, sf_dir),
            "transactions": transactions(spark, sf_dir), "crm": crm(spark, sf_dir)}
