"""Reading, promoting and profiling the raw tables, exported from the sample tables as text."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitf.catalog.common import as_bigint, rounded, with_ctes
from pitf.session import scratch_path
from pitf.sources import raw, tables
from pitf.sources import sample_tables as st

# Column counts of the given tables, as the oracle cannot see a view's width portably.
WIDTHS = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11, "events": 6,
          "documents": 5, "embeddings": 3, "pages": 3, "benchmark": 2, "labels": 3, "conversations": 4}


def _spoil(value: Column, key: Column, every: int, junk: str) -> Column:
    """Replace the value of every n-th row by something unreadable."""
    return F.when(key % every == 0, F.lit(junk)).otherwise(value.cast("string"))


def _day(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd")


def export_raw(spark: SparkSession, sf: str, keys: Iterable[str] = raw.RAW_FILES) -> str:
    """Raw tables as pipe-separated text with some unreadable fields."""
    root = scratch_path(spark, "raw")
    cid, tid, iid, pid = (F.col(c) for c in ("customer_id", "transaction_id", "interaction_id", "product_id"))
    frames = {
        "customers": st.customers(spark, sf).select(
            cid, F.concat(F.lit("first"), cid).alias("first_name"), F.lit("last").alias("last_name"),
            F.concat(cid, F.lit("@example.org")).alias("email"), F.lit("0900").alias("mobile"), "gender",
            _spoil(_day("date_of_birth"), cid, 31, "unknown").alias("date_of_birth"),
            _spoil(_day("signup_date"), cid, 37, "1994-13-45").alias("signup_date")),
        "enrollments": st.enrollments(spark, sf).select(
            pid, cid, "product_type", _spoil(_day("enrollment_date"), pid, 41, "soon").alias("enrollment_date"),
            _spoil(F.col("limit"), pid, 43, "none").alias("limit")),
        "transactions": st.transactions(spark, sf).select(
            F.lit(1).alias("product_id"), cid,
            _spoil(F.col("transaction_amount"), tid, 89, "free").alias("transaction_amount"),
            "closing_balance",
            _spoil(F.date_format("transaction_date", "yyyy-MM-dd HH:mm:ss"), tid, 97, "n/a").alias("transaction_date"),
            tid),
        "crm": st.crm(spark, sf).select(
            iid, cid, "interaction_type", _spoil(_day("interaction_date"), iid, 53, "2025/01/01").alias("interaction_date")),
    }
    for key in keys:
        frames[key].select(*raw.table_schema(key).names).write.option("sep", "|").option("header", True).csv(
            f"{root}/{raw.RAW_FILES[key]}")
    return root


def _readable(df: DataFrame) -> DataFrame:
    """Timestamps and dates as text, integers as BIGINT, and no reserved column name."""
    pattern = {"timestamp": "yyyy-MM-dd HH:mm:ss", "date": "yyyy-MM-dd"}
    shown = df.select(*[
        F.date_format(f"`{c}`", pattern[t]).alias(c) if t in pattern
        else F.col(f"`{c}`").alias("credit_limit" if c == "limit" else c) for c, t in df.dtypes])
    return rounded(as_bigint(shown), 2)


def _read_back(spark: SparkSession, sf: str, key: str) -> DataFrame:
    return _readable(raw.read_raw(spark, export_raw(spark, sf, [key]), [key])[key])


def raw_customers(spark: SparkSession, sf: str) -> DataFrame:
    return _read_back(spark, sf, "customers")


def raw_enrollments(spark: SparkSession, sf: str) -> DataFrame:
    return _read_back(spark, sf, "enrollments")


def raw_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return _read_back(spark, sf, "transactions")


def raw_interactions(spark: SparkSession, sf: str) -> DataFrame:
    return _read_back(spark, sf, "crm")


def _promoted(spark: SparkSession, sf: str, keys: Iterable[str] = raw.RAW_FILES) -> dict[str, DataFrame]:
    paths = raw.promote(spark, export_raw(spark, sf, keys), scratch_path(spark, "typed"), keys)
    return {key: tables.read_table(spark, path, raw.table_schema(key)) for key, path in paths.items()}


def promoted_customers(spark: SparkSession, sf: str) -> DataFrame:
    return _readable(_promoted(spark, sf, ["customers"])["customers"])


def promoted_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return _readable(_promoted(spark, sf, ["transactions"])["transactions"])


def promoted_enrollments(spark: SparkSession, sf: str) -> DataFrame:
    return _readable(_promoted(spark, sf, ["enrollments"])["enrollments"])


def promoted_interactions(spark: SparkSession, sf: str) -> DataFrame:
    return _readable(_promoted(spark, sf, ["crm"])["crm"])


def promoted_reordered(spark: SparkSession, sf: str) -> DataFrame:
    """Transactions from a file with its columns in another order and one more: names decide."""
    folder = scratch_path(spark, "reordered")
    text = raw.typed_projection(spark.read.options(sep="|", header=True).csv(
        f"{export_raw(spark, sf, ['transactions'])}/{raw.RAW_FILES['transactions']}"), "transactions")
    text = text.withColumn("transaction_date", F.date_format("transaction_date", raw.TIMESTAMP_FORMAT))
    (text.select(F.lit("x").alias("note"), *sorted(text.columns, reverse=True))
     .write.options(sep="|", header=True).csv(f"{folder}/{raw.RAW_FILES['transactions']}"))
    path = raw.promote(spark, folder, scratch_path(spark, "typed"), ["transactions"])["transactions"]
    return _readable(tables.read_table(spark, path, raw.table_schema("transactions")))


def load_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per table as the load itself observed them."""
    return _audit(spark, sf).select("table", "row_count")


def load_failures(spark: SparkSession, sf: str) -> DataFrame:
    """Unreadable fields per column, observed by the load."""
    return raw.load_failures(_audit(spark, sf))


def _audit(spark: SparkSession, sf: str) -> DataFrame:
    return raw.promote_audited(spark, export_raw(spark, sf), scratch_path(spark, "typed"))[1]


def table_shapes(spark: SparkSession, sf: str) -> DataFrame:
    return raw.shape_report({name: spark.read.parquet(f"{sf}/{name}.parquet") for name in WIDTHS})


def mixed_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Order dates spelled in six ways, one of them unreadable, parsed back."""
    ts, key = F.col("transaction_date"), F.col("transaction_id")
    formats = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd", "yyyy/MM/dd", "dd.MM.yyyy"]
    spelled = F.lit("not a date")
    for i, pattern in enumerate(formats):
        spelled = F.when(key % 6 == i, F.date_format(ts, pattern)).otherwise(spelled)
    text = st.transactions(spark, sf).select("transaction_id", spelled.alias("when"))
    return _readable(raw.parse_mixed_dates(text, "when"))


def column_added(spark: SparkSession, sf: str) -> DataFrame:
    """A partitioned table whose later partitions have one column more."""
    path = scratch_path(spark, "profiles")
    rows = st.transactions(spark, sf).select(
        "transaction_id", "transaction_amount", F.year("transaction_date").cast("string").alias("year"))
    tables.write_table(rows.where("year < '1998'"), path, partition_by="year")
    later = rows.where("year >= '1998'").withColumn("is_large", F.col("transaction_amount") > 100000)
    tables.write_table(later, path, partition_by="year")
    merged = tables.read_table(spark, path, merge_schema=True)
    shown = {"year": F.col("year").cast("bigint"), "is_large": F.col("is_large").cast("string")}
    return rounded(merged.withColumns(shown), 2)


def table_replaced(spark: SparkSession, sf: str) -> DataFrame:
    """A whole-table overwrite that also adds a column."""
    path = scratch_path(spark, "balances")
    rows = st.transactions(spark, sf).select("transaction_id", "closing_balance")
    tables.write_table(rows, path)
    tables.write_table(rows.withColumn("rounded", F.round("closing_balance", 0)), path)
    return rounded(tables.read_table(spark, path), 2)


CUSTOMERS = """SELECT customer_id, 'first' || customer_id AS first_name, 'last' AS last_name,
    customer_id || '@example.org' AS email, {mobile} AS mobile, gender,
    strftime(CASE WHEN customer_id % 31 <> 0 THEN date_of_birth END, '{fmt}') AS date_of_birth,
    strftime(CASE WHEN customer_id % 37 <> 0 THEN signup_date END, '{fmt}') AS signup_date FROM customers"""
TRANSACTIONS = """SELECT 1::BIGINT AS product_id, customer_id,
    CASE WHEN transaction_id % 89 <> 0 THEN round(transaction_amount, 2) END AS transaction_amount,
    round(closing_balance, 2) AS closing_balance,
    strftime(CASE WHEN transaction_id % 97 <> 0 THEN transaction_date END, '%Y-%m-%d %H:%M:%S') AS transaction_date,
    transaction_id FROM transactions"""
ENROLLMENTS = """SELECT product_id, customer_id, product_type,
    strftime(CASE WHEN product_id % 41 <> 0 THEN date_trunc('day', enrollment_date) END, '{fmt}') AS enrollment_date,
    CASE WHEN product_id % 43 <> 0 THEN round(credit_limit, 2) END AS credit_limit FROM enrollments"""
TS = "%Y-%m-%d %H:%M:%S"

# What export_raw makes unreadable: table, field, key, every how many of its values.
SPOILED = [("customers", "date_of_birth", "customer_id", 31), ("customers", "signup_date", "customer_id", 37),
           ("enrollments", "enrollment_date", "product_id", 41), ("enrollments", "limit", "product_id", 43),
           ("transactions", "transaction_amount", "transaction_id", 89), ("transactions", "transaction_date", "transaction_id", 97),
           ("crm", "interaction_date", "interaction_id", 53)]

QUERIES = {
    "raw_customers": (raw_customers, with_ctes(CUSTOMERS.format(mobile="'0900'", fmt=TS))),
    "raw_enrollments": (raw_enrollments, with_ctes(
        """SELECT product_id, customer_id, product_type,
           strftime(CASE WHEN product_id % 41 <> 0 THEN date_trunc('day', enrollment_date) END, '%Y-%m-%d %H:%M:%S')
               AS enrollment_date,
           CASE WHEN product_id % 43 <> 0 THEN round(credit_limit, 2) END AS credit_limit FROM enrollments""")),
    "raw_transactions": (raw_transactions, with_ctes(f"{TRANSACTIONS} WHERE transaction_id % 97 <> 0")),
    "raw_interactions": (raw_interactions, with_ctes(
        """SELECT interaction_id, customer_id, interaction_type,
           strftime(date_trunc('day', interaction_date), '%Y-%m-%d %H:%M:%S') AS interaction_date
           FROM crm WHERE interaction_id % 53 <> 0""")),
    "promoted_customers": (promoted_customers, with_ctes(CUSTOMERS.format(mobile="'0900'", fmt="%Y-%m-%d"))),
    "promoted_transactions": (promoted_transactions, with_ctes(TRANSACTIONS)),
    "promoted_enrollments": (promoted_enrollments, with_ctes(ENROLLMENTS.format(fmt="%Y-%m-%d"))),
    "promoted_interactions": (promoted_interactions, with_ctes(
        """SELECT interaction_id, customer_id, interaction_type,
           strftime(CASE WHEN interaction_id % 53 <> 0 THEN interaction_date END, '%Y-%m-%d') AS interaction_date FROM crm""")),
    "promoted_reordered": (promoted_reordered, with_ctes(TRANSACTIONS)),
    "load_audit": (load_audit, with_ctes(" UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", count(*) AS row_count FROM {t}"
        for t in ("customers", "enrollments", "transactions", "crm")))),
    "load_failures": (load_failures, with_ctes("SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", '{field}' AS field, count(*) FILTER ({key} % {every} = 0) AS failed FROM {t}"
        for t, field, key, every in SPOILED) + ") WHERE failed > 0")),
    "table_shapes": (table_shapes, " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", count(*) AS row_count, CAST({w} AS BIGINT) AS column_count FROM {t}"
        for t, w in WIDTHS.items())),
    "mixed_dates": (mixed_dates, with_ctes(
        """SELECT transaction_id, CASE WHEN transaction_id % 6 < 2 THEN strftime(transaction_date, '%Y-%m-%d %H:%M:%S')
           WHEN transaction_id % 6 < 5 THEN strftime(transaction_date, '%Y-%m-%d 00:00:00') END AS "when"
           FROM transactions""")),
    "column_added": (column_added, with_ctes(
        """SELECT transaction_id, round(transaction_amount, 2) AS transaction_amount, year(transaction_date) AS year,
           CAST(CASE WHEN year(transaction_date) >= 1998 THEN transaction_amount > 100000 END AS VARCHAR) AS is_large
           FROM transactions""")),
    "table_replaced": (table_replaced, with_ctes(
        """SELECT transaction_id, round(closing_balance, 2) AS closing_balance, round(closing_balance, 0) AS rounded
           FROM transactions""")),
}
