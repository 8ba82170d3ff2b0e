"""All registered queries with their oracle SQL."""
from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from pitf.catalog import (
    feature_queries, metric_queries, model_queries, monitor_queries, registry_queries, source_queries, sweep_queries,
)
from pitf.session import prepare

GROUPS = (source_queries, feature_queries, sweep_queries, metric_queries, registry_queries, model_queries,
          monitor_queries)


def _run(query: Callable[[SparkSession, str], DataFrame], spark: SparkSession, sf_dir: str) -> DataFrame:
    return query(prepare(spark), sf_dir.rstrip("/"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: partial(_run, query) for group in GROUPS for name, (query, _) in group.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for group in GROUPS for name, (_, sql) in group.QUERIES.items() if sql}
