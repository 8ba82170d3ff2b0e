"""Registered queries of the subpackage: each applies one operator to its whole table."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitf.llm import (
    bytebpe,
    divergence,
    fingerprint,
    html_extract,
    katz,
    langid,
    mixing,
    ngram_join,
    packing,
    quality,
    spelling,
    topk,
    toxicity,
)
from pitf.llm.labelled import fold


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path() -> str:
    """Vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.copies(_table(spark, sf_dir, "documents"))
    # Rows of one id, source and size are alike: the first of them take the copies above the common number.
    each = plan.withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    own = F.floor(F.col("taken") / F.col("rows")) + (F.col("nth") <= F.col("taken") % F.col("rows")).cast("long")
    return each.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                       (own * F.col("size")).cast("long").alias("taken"), "source")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("length"),
                         F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract(_table(spark, sf_dir, "pages"), keep=("page_id", "url"))
    return found.select("page_id", "url", F.col("_text").alias("text"), F.col("_chars").alias("n_chars"))


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.link_components(_table(spark, sf_dir, "documents"), width=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprint.compare_neighbours(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "fingerprint",
                        "edited_fingerprint", "near_edited", "near_next")


def _judged(scored: DataFrame, held_out) -> DataFrame:
    return scored.select("doc_id", held_out.alias("held_out"), F.col("_score").alias("score"),
                         (F.col("_score") >= 0.5).cast("int").alias("predicted"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    return _judged(quality.score(docs, model, keep=("doc_id",)), fold("doc_id", 3) == 1)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return _judged(toxicity.score(docs, model, keep=("doc_id",)), fold("doc_id", 5) == 0)


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.log_probabilities(_table(spark, sf_dir, "documents"), fold("doc_id", 5) == 1)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents; their source is the host, a ``lang`` attribute in the text the declared language."""
    docs = _table(spark, sf_dir, "documents")
    found = langid.identify(docs.select("doc_id", "source", "text"), langid.fit(docs), F.col("text"),
                            langid.markup_language(F.col("text")), langid.address_suffix(F.col("source")), F.col("source"))
    return found.select("doc_id", F.col("_language").alias("language"), F.col("_probability").alias("probability"),
                        F.col("_accepted").alias("accepted"))


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages: main text, ``lang`` attribute, host and its suffix."""
    pages = html_extract.extract(_table(spark, sf_dir, "pages"))
    host = langid.address_host(F.col("url"))
    found = langid.identify(pages, langid.fit(_table(spark, sf_dir, "documents")), F.col("_text"),
                            langid.markup_language(F.col("html")), langid.address_suffix(host), host)
    return found.select("page_id", F.col("_language").alias("language"), F.col("_probability").alias("probability"),
                        F.col("_accepted").alias("accepted"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bytebpe.encode(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bytebpe.decode(encoded, ranks).select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                                                 F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.count_words(_table(spark, sf_dir, "documents"), least_length=7, least_count=2, every=31)
    return spelling.variants(words, factor=10).select("word", "form", "root", "n", "n_near", "form_n")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_mixing, op2_packing, op3_html_extraction, op4_top_k, op5_ngram_join, op6_quality, op7_fingerprints,
                            op8_toxicity, op9_lm_scoring, op10_language_id, language_id_pages, op11_byte_bpe,
                            op12_spelling_variants, op13_source_divergence)
}
SQL: dict[str, str] = {}

SQL["op4_top_k"] = """
WITH v AS (SELECT row_number() OVER () AS own, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
           FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT q.own, q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
           FROM v q JOIN v c ON q.own <> c.own AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0 AND len(q.e) > 0),
     r AS (SELECT *, CAST(row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

SQL["op13_source_divergence"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
     t AS (SELECT rid, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                                               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
     c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT rid) AS docs FROM t GROUP BY ALL),
     k AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL HAVING sum(docs) >= 30),
     l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
     g AS (SELECT lang, source, coalesce(v, 0) AS v, l.total AS lang_total FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN l USING (lang)),
     e AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n, g.v, g.lang_total
           FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
     s AS (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS total FROM e),
     p AS (SELECT lang, source, term, n, 1 + (CAST(1000000000 AS HUGEINT) * (n + 5)) // CAST(total + 5 * v AS HUGEINT) AS p,
                  1 + (CAST(1000000000 AS HUGEINT) * (lang_n + 5)) // CAST(lang_total + 5 * v AS HUGEINT) AS q FROM s),
     f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
           FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
     r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
           FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
           LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
           UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
     o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM o WHERE part = 'pair' OR rank <= 50
"""
