"""The pipeline stage by stage, each against what its operator says about the stage's own input."""
from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from pitf.session import materialise

DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, materialise(stage(spark, docs, DIR), name)
        assert docs.columns == columns
        if name == "mixing":
            assert docs.select("doc_id").distinct().join(before, "doc_id", "left_anti").isEmpty()
        else:
            assert docs.exceptAll(before).isEmpty()
        counts.append(docs.count())
    assert 0 < counts[3] <= counts[2] <= counts[1] <= counts[0]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, DIR)
    fills = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert fills.where("n <> end OR n > 2048").isEmpty()


def test_copies_with_repeated_or_missing_ids_are_dropped(spark):
    text = " ".join(f"w{i}" for i in range(40))
    other, third = text.replace("w", "v"), text.replace("w", "u")
    rows = [(1, text, "en"), (1, text, "en"), (2, text, "en"), (None, text, "en"), (None, text + " end", "de"),
            (3, other, "en"), (3, text, "en"), (None, third, "en"), (None, third, "en"), (None, third, None),
            (7, "", "en"), (7, "", "en"), (8, None, "en")]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING").repartition(3)
    found = corpus_pipeline.one_of_each(spark, docs, DIR)
    assert found.columns == docs.columns
    kept = sorted((tuple(r) for r in found.collect()), key=str)
    words = [r for r in kept if r[1]]
    assert [r[:2] for r in words if r[0] is not None] == [(1, text), (3, other)]
    assert [r[:2] for r in words if r[0] is None] == [(None, third)]
    assert sorted((r for r in kept if not r[1]), key=str) == [(7, "", "en"), (7, "", "en"), (8, None, "en")]
