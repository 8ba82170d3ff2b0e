"""Session settings and the shared folder for intermediate tables."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Temporary folder by application, of local sessions without a shared one.
_LOCAL_ROOTS: dict[str, str] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session time zone; every cutoff in the library is UTC midnight."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder, the library's own: the session's checkpoint folder stays unset.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):  # local-cluster has executors of its own
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[application] = tempfile.mkdtemp(prefix="pitf-")
    return _LOCAL_ROOTS[application]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, in one folder per application, so that
    everything a finished application left behind can be dropped at once."""
    return f"{shared_root(spark)}/pitf-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}/{name}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage with a table that outlives any executor, and gives the
    planner real sizes for whatever is built on top.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)
