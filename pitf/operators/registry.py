"""Model registry as a table, with set-wise queries over any number of models.

Every operator works per ``model_name``: one name is a single model's registry,
many names are one registry per segment, in the same plan.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitf.sources.tables import drop_path, publish, published, typed_rows

# Registry columns.
REGISTRY_SCHEMA = (
    "model_name STRING, version INT, model_path STRING, run_id STRING, roc_auc DOUBLE, average_precision DOUBLE, "
    "ap_lift_over_base DOUBLE, created_at STRING, alias STRING, input_hash STRING"
)
CHAMPION = "champion"
COMMIT = "commit"
# Reason codes of the gate outside its rules.
GATE_PASSED, NOTHING_REGISTERED = "passed", "nothing_registered"


@dataclass(frozen=True)
class GatePolicy:
    """Least AUC, least lift, allowed AUC loss against the champion."""

    min_roc_auc: float = 0.58
    min_ap_lift_over_base: float = 1.10
    max_roc_auc_regression: float = 0.02


def _newest(rows: DataFrame, *keys: str) -> DataFrame:
    """Highest version per key. The row_number filter lets Spark drop all but one
    row per key and task before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.desc("version"))
    return rows.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def latest(registry: DataFrame) -> DataFrame:
    """Newest version of every model."""
    return _newest(registry, "model_name")


def by_alias(registry: DataFrame, alias: str = CHAMPION) -> DataFrame:
    """Version of every model that holds the alias."""
    return _newest(registry.where(F.col("alias") == alias), "model_name")


def by_input_hash(registry: DataFrame) -> DataFrame:
    """Newest version for every model and training fingerprint."""
    return _newest(registry.where("input_hash IS NOT NULL AND input_hash <> ''"), "model_name", "input_hash")


def next_versions(registry: DataFrame, models: DataFrame) -> DataFrame:
    """(model_name, next_version) for the given models; 1 when a model is new."""
    used = registry.groupBy("model_name").agg(F.max("version").alias("version"))
    return models.select("model_name").join(used, "model_name", "left").select(
        "model_name", (F.coalesce("version", F.lit(0)) + 1).alias("next_version"))


def append(registry: DataFrame, additions: DataFrame) -> DataFrame:
    """Registry with new rows, one per model, numbered after the versions present."""
    numbered = additions.drop("version").join(next_versions(registry, additions), "model_name")
    return registry.unionByName(numbered.withColumnRenamed("next_version", "version"), allowMissingColumns=True)


def move_alias(registry: DataFrame, targets: DataFrame, alias: str = CHAMPION) -> DataFrame:
    """Give the alias to (model_name, version) of ``targets`` and take it from the
    previous holder of those models; other models keep theirs.

    Holders are few (one per model) and need only the model; all other rows are
    matched on model and version, so no join key gathers a model's whole history.
    """
    wanted = targets.select("model_name", F.col("version").alias("_version"))
    columns = registry.columns
    holds = F.coalesce(F.col("alias") == alias, F.lit(False))
    held = registry.where(holds).join(wanted, "model_name", "left").withColumn(
        "alias", F.when(F.col("_version").isNull() | (F.col("_version") == F.col("version")), F.lit(alias)))
    rest = registry.where(~holds).withColumnRenamed("version", "_version").join(
        wanted.withColumn("_hit", F.lit(True)), ["model_name", "_version"], "left").withColumn(
        "alias", F.when(F.col("_hit"), F.lit(alias)).otherwise(F.col("alias"))).withColumnRenamed("_version", "version")
    return held.select(*columns).unionByName(rest.select(*columns))


def gate_reason(auc: Column, lift: Column, champion_auc: Column, gate: GatePolicy) -> Column:
    """Codes of the rules broken, joined by ``+``; empty when none is. A missing metric is a code of its own."""
    broken = [
        ("metric_missing", auc.isNull() | lift.isNull()),
        ("auc_low", auc < gate.min_roc_auc),
        ("lift_low", lift < gate.min_ap_lift_over_base),
        ("auc_below_champion", champion_auc - auc > gate.max_roc_auc_regression),
    ]
    return F.concat_ws("+", *[F.when(rule, code) for code, rule in broken])


def evaluate_gate(registry: DataFrame, gate: GatePolicy = GatePolicy(), alias: str = CHAMPION) -> DataFrame:
    """Per model: newest version against the rules and the current champion.

    The champion check is skipped when the champion is that same version.
    Missing metrics reject.
    """
    champion = by_alias(registry, alias).select(
        "model_name", F.col("version").alias("_champion"), F.col("roc_auc").alias("_champion_auc"))
    rows = latest(registry).join(champion, "model_name", "left")
    champion_auc = F.when(F.col("_champion") != F.col("version"), F.col("_champion_auc"))
    broken = gate_reason(F.col("roc_auc"), F.col("ap_lift_over_base"), F.col("champion_roc_auc"), gate)
    return rows.withColumn("champion_roc_auc", champion_auc).select(
        "model_name", "version", "roc_auc", "ap_lift_over_base", "champion_roc_auc",
        (broken == "").alias("promote"), F.when(broken == "", GATE_PASSED).otherwise(broken).alias("reason"))


def promote(registry: DataFrame, gate: GatePolicy = GatePolicy(), alias: str = CHAMPION) -> DataFrame:
    """Registry after the gate: the alias moves to every newest version that passed."""
    return move_alias(registry, evaluate_gate(registry, gate, alias).where("promote"), alias)


def compare_candidates(metrics: DataFrame, order: list[str]) -> DataFrame:
    """Per model_name: winner by AUC (earlier in ``order`` on a tie), runner-up AUC and margin."""
    rank = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model_type"))
    by_auc = Window.partitionBy("model_name").orderBy(F.desc("roc_auc"), rank)
    placed = metrics.withColumn("_place", F.row_number().over(by_auc)).where("_place <= 2")
    return placed.groupBy("model_name").agg(
        F.max(F.when(F.col("_place") == 1, F.col("model_type"))).alias("winner"),
        F.max(F.when(F.col("_place") == 1, F.col("roc_auc"))).alias("winner_roc_auc"),
        F.coalesce(F.max(F.when(F.col("_place") == 2, F.col("roc_auc"))), F.lit(0.0)).alias("runner_up_roc_auc"),
    ).withColumn("roc_auc_margin", F.round(F.col("winner_roc_auc") - F.col("runner_up_roc_auc"), 4))


class CommitConflict(RuntimeError):
    """Other writers took every number a commit tried for."""


class RegistryStore:
    """Registry kept as full states below one path, and numbered commits that name the state in force.

    A state is written to a folder of its own; it comes into force when a commit file with the next number and the folder's
    name appears. The file is created only if absent (``tables.publish``), so of two writers that started from one state
    one commits, and the other applies its change again to what it finds then: no update is lost. A writer that dies
    leaves a folder nobody reads. The newest ``keep`` states stay for readers under way; older ones are dropped.
    """

    def __init__(self, spark: SparkSession, path: str, keep: int = 10) -> None:
        if keep < 1:
            raise ValueError(f"keep must be at least 1, got {keep}")
        self.spark, self.path, self.keep = spark, path, keep

    def read(self) -> DataFrame:
        return self._read(self._commits())

    def update(self, change: Callable[[DataFrame], DataFrame], attempts: int = 20) -> int:
        """Commit ``change(current state)``; returns the number of the commit."""
        for _ in range(attempts):
            commits = self._commits()
            number, folder = max(commits, default=0) + 1, f"state-{uuid.uuid4().hex}"
            change(self._read(commits)).write.parquet(f"{self.path}/{folder}")
            if publish(self.spark, f"{self.path}/commits/{number:010d}.{COMMIT}", folder):
                self._retain(commits | {number: folder})
                return number
            drop_path(self.spark, f"{self.path}/{folder}")
        raise CommitConflict(f"{self.path}: {attempts} attempts")

    def write(self, registry: DataFrame) -> int:
        """Replace the state by rows that don't depend on it; ``update`` is for those that do."""
        return self.update(lambda _: registry)

    def _commits(self) -> dict[int, str]:
        """Folder by number of the states that are kept."""
        return {int(name.partition(".")[0]): folder for name, folder in
                published(self.spark, f"{self.path}/commits", COMMIT).items()}

    def _read(self, commits: dict[int, str]) -> DataFrame:
        if not commits:
            return typed_rows(self.spark, [], REGISTRY_SCHEMA)
        return self.spark.read.schema(REGISTRY_SCHEMA).parquet(f"{self.path}/{commits[max(commits)]}")

    def _retain(self, commits: dict[int, str]) -> None:
        for number in sorted(commits)[:-self.keep]:
            # The commit goes first: what is listed can be read.
            drop_path(self.spark, f"{self.path}/commits/{number:010d}.{COMMIT}")
            drop_path(self.spark, f"{self.path}/{commits[number]}")
