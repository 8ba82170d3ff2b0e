"""Connected components of a link table, as joins and aggregates."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitf.session import materialise


def connected(links: DataFrame) -> DataFrame:
    """``set_id`` and ``component`` (smallest node reachable) of every node of ``links`` (a, b).

    Each round gives a node the smallest label among itself and its neighbours, then the label of
    that label, so long chains shorten by halves; it ends when no label changes. Every round is
    written to the shared folder.
    """
    links = links.select("a", "b").union(links.select("b", "a"))
    labels = materialise(links.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = (links.join(labels.select(F.col("a").alias("b"), F.col("label").alias("beside")), "b")
                .groupBy("a").agg(F.min("beside").alias("beside")))
        stepped = labels.join(near, "a").select(
            "a", F.col("label").alias("before"), F.least("label", "beside").alias("label"))
        onward = labels.select(F.col("a").alias("label"), F.col("label").alias("further"))
        stepped = materialise(
            stepped.join(onward, "label", "left")
            .select("a", "before", F.least("label", F.coalesce("further", "label")).alias("label")), "labels")
        labels = stepped.select("a", "label")
        if stepped.where("before <> label").isEmpty():
            return labels.select(F.col("a").alias("set_id"), F.col("label").alias("component"))
