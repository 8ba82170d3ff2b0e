"""Derived tables on shared storage (Parquet directories), and small files created only if absent."""
from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> str:
    """Replace a table. With ``partition_by`` only the partitions present in ``df``
    are replaced, so re-running one date leaves the others alone."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by).option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.option("partitionOverwriteMode", "static")
    writer.parquet(path)
    return path


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               merge_schema: bool = False) -> DataFrame:
    """Read a table; ``merge_schema`` accepts partitions written before a column was added."""
    reader = spark.read.option("mergeSchema", merge_schema)
    return (reader.schema(schema) if schema else reader).parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def typed_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """Few driver-made rows with a declared schema, safe for all-NULL columns."""
    return spark.createDataFrame(list(rows), schema)


def conform(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Project to a declared schema: order and types from the declaration, missing columns NULL."""
    target = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target
    ])


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of Spark's own storage layer."""
    java = spark.sparkContext._jvm
    where = java.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with its whole content if there is none; ``False`` if there is one.

    The text goes to a file beside it, which then takes the name: a hard link on a local or mounted folder, a rename that
    refuses to overwrite elsewhere. Both are atomic (POSIX, HDFS), so of any number of writers exactly one succeeds, and
    no reader sees half a file. Not for object stores, where a rename is a copy.
    """
    folder, _, name = path.rpartition("/")
    fs, where = _hadoop(spark, path)
    _, beside = _hadoop(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    stream = fs.create(beside, False)
    stream.write(text.encode())
    stream.close()
    try:
        if fs.getUri().getScheme() == "file":
            os.link(beside.toUri().getPath(), where.toUri().getPath())
            return True
        java = spark.sparkContext._jvm
        none = spark.sparkContext._gateway.new_array(java.org.apache.hadoop.fs.Options.Rename, 0)
        context = java.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
        context.rename(beside, where, none)
        return True
    except FileExistsError:
        return False
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        return False
    finally:
        fs.delete(beside, False)


def published(spark: SparkSession, folder: str, suffix: str) -> dict[str, str]:
    """Text by name of the small files in a folder that end in the suffix."""
    try:
        rows = spark.read.options(wholetext=True, pathGlobFilter=f"*.{suffix}", ignoreMissingFiles=True).text(folder)
        found = rows.select(F.col("_metadata.file_name").alias("name"), "value").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return {r["name"]: r["value"] for r in found}


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there."""
    fs, where = _hadoop(spark, path)
    fs.delete(where, True)
