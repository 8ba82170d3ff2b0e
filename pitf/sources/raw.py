"""Raw customer tables: schemas, readers, typed promotion and audits."""
from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitf.functions.scalars import parse_first
from pitf.sources.tables import typed_rows

# File names, columns, types and date formats of the raw feed.
RAW_FILES = {
    "customers": "customer_raw.csv",
    "enrollments": "product_enrollments.csv",
    "transactions": "transaction_history.csv",
    "crm": "crm_interactions.csv",
}
DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
RAW_COLUMNS = {
    "customers": "customer_id INT, first_name STRING, last_name STRING, email STRING, mobile STRING, "
                 "gender STRING, date_of_birth DATE, signup_date DATE",
    "enrollments": "product_id INT, customer_id INT, product_type STRING, enrollment_date DATE, `limit` DOUBLE",
    "transactions": "product_id INT, customer_id INT, transaction_amount DOUBLE, closing_balance DOUBLE, "
                    "transaction_date TIMESTAMP, transaction_id BIGINT",
    "crm": "interaction_id BIGINT, customer_id INT, interaction_type STRING, interaction_date DATE",
}
# Rows of these tables are useless without their event time.
EVENT_TIME = {"transactions": "transaction_date", "crm": "interaction_date"}
# Accepted spellings of a date in files of unknown origin.
MIXED_FORMATS = (TIMESTAMP_FORMAT, "yyyy-MM-dd'T'HH:mm:ss", DATE_FORMAT, "yyyy/MM/dd", "dd.MM.yyyy")


def table_schema(key: str) -> T.StructType:
    """Declared types of a raw table (dates as DATE or TIMESTAMP)."""
    return T.StructType.fromDDL(RAW_COLUMNS[key])


def _is_time(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.DateType, T.TimestampType))


def landing_schema(key: str) -> T.StructType:
    """Types as read from CSV: every date lands as text and is parsed afterwards,
    so one malformed row cannot change a column's type."""
    return T.StructType([
        T.StructField(f.name, T.StringType() if _is_time(f) else f.dataType) for f in table_schema(key)
    ])


def read_delimited(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Pipe-separated text with a header in the order of the schema; another order or name is an error, a malformed
    typed field becomes NULL."""
    return spark.read.options(sep="|", header=True, enforceSchema=False).schema(schema).csv(path)


def read_raw_table(spark: SparkSession, raw_dir: str, key: str) -> DataFrame:
    """One raw table with its dates parsed to timestamps; unparseable dates are NULL."""
    df = read_delimited(spark, f"{raw_dir.rstrip('/')}/{RAW_FILES[key]}", landing_schema(key))
    parsed = {
        f.name: F.try_to_timestamp(
            F.col(f.name), F.lit(DATE_FORMAT if isinstance(f.dataType, T.DateType) else TIMESTAMP_FORMAT))
        for f in table_schema(key) if _is_time(f)
    }
    return df.withColumns(parsed)


def read_raw(spark: SparkSession, raw_dir: str, keys: Iterable[str] = RAW_FILES) -> dict[str, DataFrame]:
    """The raw tables; transactions and interactions without a usable time are dropped."""
    return {key: _timed(read_raw_table(spark, raw_dir, key), key) for key in keys}


def _timed(df: DataFrame, key: str) -> DataFrame:
    """Events without a time are useless, those without a customer belong to nobody: both are dropped."""
    if key not in EVENT_TIME:
        return df
    return df.where(F.col(EVENT_TIME[key]).isNotNull() & F.col("customer_id").isNotNull())


def typed_projection(df: DataFrame, key: str) -> DataFrame:
    """Cast an all-text frame to the declared types, by column name; a bad cast gives NULL,
    columns outside the declaration are left behind, a declared one that is absent is an error."""
    return df.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in table_schema(key)])


LOAD_AUDIT = "table STRING, row_count BIGINT, failed MAP<STRING, BIGINT>"


def promote(spark: SparkSession, raw_dir: str, target_dir: str, keys: Iterable[str] = RAW_FILES) -> dict[str, str]:
    """Load each CSV once into a typed Parquet table; later reads then prune and push down."""
    return promote_audited(spark, raw_dir, target_dir, keys)[0]


def _observing_session(spark: SparkSession) -> SparkSession:
    """A session of the same context and settings for observed jobs.

    An observation leaves a session that Java cannot serialize, and fitted models keep their session in their training
    summary: scoring with them in the caller's session would fail. Only its own session carries the observations.
    """
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            own.conf.set(name, value)
    return own


def promote_audited(spark: SparkSession, raw_dir: str, target_dir: str,
                    keys: Iterable[str] = RAW_FILES) -> tuple[dict[str, str], DataFrame]:
    """Paths of the typed tables, and one audit row per table: rows written and, per column, texts no cast could read.

    The figures are observed by the very job that writes the table, so nothing is read again for them and they tell what
    was written. A missing field is not a failure.
    """
    paths, audit = {}, []
    loader = _observing_session(spark)
    for key in keys:
        paths[key] = f"{target_dir.rstrip('/')}/{key}"
        # Without a schema every column is text under its header's name, in whatever order the file has.
        text = loader.read.options(sep="|", header=True).csv(f"{raw_dir.rstrip('/')}/{RAW_FILES[key]}")
        fields = table_schema(key).fields
        text = text.select(*[F.col(f"`{f.name}`") for f in fields])
        seen = Observation(f"load of {key}")
        lost = [F.count_if(F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull()).alias(f"failed_{i}")
                for i, f in enumerate(fields)]
        typed = typed_projection(text.observe(seen, F.count(F.lit(1)).alias("rows"), *lost), key)
        typed.write.mode("overwrite").parquet(paths[key])
        got = seen.get
        audit.append((key, got["rows"], {f.name: got[f"failed_{i}"] for i, f in enumerate(fields)}))
    return paths, typed_rows(spark, audit, LOAD_AUDIT)


def load_failures(audit: DataFrame) -> DataFrame:
    """(table, field, failed) of the columns that lost values in a load."""
    return audit.select("table", F.explode("failed").alias("field", "failed")).where("failed > 0")


def read_promoted(spark: SparkSession, target_dir: str, keys: Iterable[str] = RAW_FILES) -> dict[str, DataFrame]:
    """Promoted tables in the form ``read_raw`` gives: dates as timestamps, unusable events dropped."""
    tables = {}
    for key in keys:
        schema = table_schema(key)
        df = spark.read.schema(schema).parquet(f"{target_dir.rstrip('/')}/{key}")
        tables[key] = _timed(df.withColumns({
            f.name: F.col(f.name).cast("timestamp") for f in schema if _is_time(f)}), key)
    return tables


def shape_report(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, row_count, column_count) of every table in one job."""
    shapes = [
        df.agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table"), "row_count",
                F.lit(len(df.columns)).cast("bigint").alias("column_count"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, shapes)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, row_count) audit after a load."""
    return shape_report(tables).drop("column_count")


def parse_mixed_dates(df: DataFrame, *names: str) -> DataFrame:
    """Parse text dates that do not share one format."""
    return df.withColumns({n: parse_first(F.col(n), MIXED_FORMATS) for n in names})
