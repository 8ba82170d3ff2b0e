"""From documents to packed training sequences: five stages, each written as Parquet and read again by the next."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitf.llm import langid, mixing, ngram_join, packing, toxicity
from pitf.llm.queries import tokenizer_path
from pitf.session import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of toxic text is below one half; the model learns from their labels."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).where("_score < 0.5").select(*docs.columns)


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language. The column ``lang`` teaches the trigrams and is no evidence for its own row."""
    found = langid.identify(docs, langid.fit(docs), F.col("text"), langid.markup_language(F.col("text")),
                            langid.address_suffix(F.col("source")), F.col("source"))
    return found.where("_accepted").select(*docs.columns)


def _row_key(docs: DataFrame) -> Column:
    """Equal for rows equal in every column only; sorts by id, rows without one last."""
    columns = [docs[c] for c in docs.columns]
    content = [*columns, *(c.isNull() for c in columns)]  # a hash passes over nulls
    key = docs["doc_id"]
    return F.struct(key.isNull().alias("no_id"), F.coalesce(key, F.lit(0).cast(docs.schema["doc_id"].dataType)).alias("doc_id"),
                    F.xxhash64(F.lit(1), *content).alias("h1"), F.xxhash64(F.lit(2), *content).alias("h2"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that with the smallest id, of every group linked by five-word shingles at 0.8 or more.

    Rows are told apart by all their columns, so a repeated id or none exempts no copy; rows without an id come last in
    a group. Of rows alike in every column one stays. Texts without a word link with nothing and all stay.
    """
    keyed = docs.withColumn("__pitf_key", _row_key(docs))
    groups = ngram_join.link_components(keyed, id_col="__pitf_key", width=5, percent=80)
    first = materialise(groups.where("__pitf_key = component_id").groupBy("__pitf_key")
                        .agg(((F.count("*") > 1) & (F.max("n_shingles") > 0)).alias("repeated")), "first")
    kept = keyed.join(first.where("NOT repeated"), "__pitf_key", "left_semi")
    repeated = first.where("repeated")
    if not repeated.isEmpty():
        kept = kept.unionByName(keyed.join(repeated, "__pitf_key", "left_semi").dropDuplicates(["__pitf_key"]))
    return kept.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: a row per copy."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences with their token ids."""
    pieces = packing.pack(docs, tokenizer_path())
    return pieces.withColumn("length", (F.length("ids") / 4).cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", keep_identified),
    ("ngram_join", one_of_each),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    sf_dir = sf_dir.rstrip("/")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Compression lengths and token ids are beyond SQL.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
