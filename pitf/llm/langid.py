"""Language identification by Bayesian evidence fusion.

A text's likelihood under each language comes from byte trigrams. It is combined with what else is known: the language
declared in the markup, the address suffix and the host. A host's language shares are smoothed towards its
suffix's and those towards the shares of all documents; how often each language is declared as which is
estimated too. All those counts are grouped sums of the documents' text-only probabilities.

One more hypothesis, ``unknown``, is that the text is in none of the languages: its symbols come as often as in the
languages together, but in no order. Every language's trigrams are smoothed towards it by Witten-Bell, so it wins where
most of a text's trigrams are ones the languages don't have.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitf.llm.textcore import slices, text_bytes
from pitf.session import materialise

#: Documents with a known language that each language's trigrams are learnt from, at most.
SAMPLE = 1500
#: Trigrams overlap and follow from each other: each counts as this share of an independent one.
TEMPER = 0.2
#: Documents' worth of belief in the level above: suffix towards all, host towards its suffix, declarations.
SUFFIX_WEIGHT = 20.0
HOST_WEIGHT = 10.0
DECLARED_WEIGHT = 5.0
#: Belief before a text is read that it is in no known language.
UNKNOWN = 0.05
#: Least probability of an accepted language; ``unknown`` must not be likelier either.
ACCEPTED = 0.3
UNDETERMINED = "und"
_BITS = 6


def _symbols() -> np.ndarray:
    """a-z as 1 to 26, bytes beyond ASCII as 27 to 58, everything else 0."""
    out = np.zeros(256, np.int32)
    out[97:123] = out[65:91] = np.arange(1, 27)
    out[128:] = 27 + (np.arange(128, 256) & 31)
    return out


def _trigrams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Code of the three symbols ending at each byte; 0 where there are no letters or the document is younger."""
    s = _symbols()[data]
    codes = s.copy()
    codes[1:] |= s[:-1] << _BITS
    codes[2:] |= s[:-2] << 2 * _BITS
    first = offsets[:-1][np.diff(offsets) > 0]
    codes[first] = 0
    codes[np.minimum(first + 1, len(codes) - 1)] = 0
    return codes


@dataclass
class LanguageModel:
    names: list[str]
    table: np.ndarray  # log of probability over that of ``unknown``, by trigram and language; zeros for code 0


def _background(counts: np.ndarray) -> np.ndarray:
    """Probability of each trigram code if symbols were drawn one by one, at the shares they have in ``counts``."""
    codes, symbol = np.arange(len(counts)), (1 << _BITS) - 1
    places = [codes >> i * _BITS & symbol for i in range(3)]
    share = sum(np.bincount(x, counts, symbol + 1) for x in places) + 1.0
    share /= share.sum()
    chance = np.prod([share[x] for x in places], axis=0)
    return chance / chance[1:].sum()


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id") -> LanguageModel:
    """Trigram tables from at most ``SAMPLE`` documents of each known language, however many there are: a table of a language takes
    1 MB on the driver and in each worker."""
    known = docs.where(F.col(lang_col).isNotNull() & (F.length(text_col) > 0))
    counts: dict[str, np.ndarray] = {}
    # The first ids of a language are cut out in each task before they meet; texts are read once, for all languages.
    first = Window.partitionBy(lang_col).orderBy(F.xxhash64(F.col(id_col).cast("string")), id_col)
    chosen = (known.groupBy(lang_col, id_col).agg(F.lit(1).alias("_one"))
              .withColumn("_nth", F.row_number().over(first)).where(F.col("_nth") <= SAMPLE).select(lang_col, id_col))
    rows = known.select(id_col, lang_col, text_col).join(F.broadcast(chosen), [lang_col, id_col]).select(lang_col, text_col)
    for name, text in rows.toLocalIterator():
        seen = counts.setdefault(name, np.zeros(1 << 3 * _BITS, np.int32))
        seen += np.bincount(_trigrams(*text_bytes(pa.array([text], pa.large_string()))), minlength=len(seen)).astype(np.int32)
    for seen in counts.values():
        seen[0] = 0
    names = sorted(name for name, seen in counts.items() if seen.any())  # nothing is learnt from digits alone
    table = np.zeros((1 << 3 * _BITS, len(names)), np.float32)
    if names:
        chance = _background(sum(counts[name].astype(np.float64) for name in names))
    for i, name in enumerate(names):
        kinds = (counts[name] > 0).sum()
        table[:, i] = np.log((counts[name] / chance + kinds) / (counts[name].sum() + kinds))
    table[0] = 0
    return LanguageModel(names, table)


def _likelihoods(model: LanguageModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = model.table.shape[1]
        for batch in slices(batches, "__pitf_text", 1 << 20):
            data, offsets = text_bytes(batch.column(batch.num_columns - 1))
            codes = _trigrams(data, offsets) if len(data) else np.zeros(0, np.int32)
            full = np.diff(offsets) > 0
            sums = np.zeros((len(full), width))
            letters = np.zeros(len(full), np.int64)
            if full.any():
                at = offsets[:-1][full]
                for i in range(width):
                    sums[full, i] = np.add.reduceat(model.table[:, i][codes], at, dtype=np.float64)
                letters[full] = np.add.reduceat((codes > 0).astype(np.int64), at)
            sums *= TEMPER
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(full) + 1) * width, pa.int32()), pa.array(sums.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists, pa.array(letters)],
                                             [*batch.schema.names[:-1], "__pitf_loglik", "__pitf_letters"])
    return run


def _normal(logs: Column) -> Column:
    """Probabilities from logarithms up to a constant."""
    top = F.array_max(logs)
    raised = F.transform(logs, lambda x: F.exp(x - top))
    total = F.aggregate(raised, F.lit(0.0), lambda a, b: a + b)
    return F.transform(raised, lambda x: x / total)


def identify(docs: DataFrame, model: LanguageModel, text: Column, declared: Column | None = None,
             suffix: Column | None = None, host: Column | None = None) -> DataFrame:
    """All columns of ``docs`` and ``_language``, ``_probability``, ``_accepted``.

    ``declared``, ``suffix`` and ``host`` are strings or NULL; NULL is evidence of nothing. A text without a letter
    trigram (null, empty, digits only) is ``und`` with probability 0 and not accepted, whatever else is known. A text
    likelier in no known language than in any is ``und`` too and not accepted; its probability is that of the best known
    one. Others are accepted from probability ``ACCEPTED``. Long texts count whole; repeated rows get equal results; with no known
    language every row is ``und``; an empty table gives no rows. Columns of the result's names are
    replaced; names that begin with ``__pitf`` are reserved.
    """
    docs = docs.drop("_language", "_probability", "_accepted")
    names = list(docs.columns)
    nothing = F.lit(None).cast("string")
    base = docs.select(*names, *((nothing if c is None else c.cast("string")).alias(n) for n, c in
                                 (("__pitf_declared", declared), ("__pitf_suffix", suffix), ("__pitf_host", host))), text.alias("__pitf_text"))
    n = len(model.names)
    if not n:
        return docs.withColumns({"_language": F.lit(UNDETERMINED), "_probability": F.lit(0.0), "_accepted": F.lit(False)})

    def measured(columns: list[str]) -> DataFrame:
        wanted = base.select(*columns, "__pitf_declared", "__pitf_suffix", "__pitf_host", "__pitf_text")
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.schema.fields[:-1])
        return wanted.mapInArrow(_likelihoods(model), f"{fields}, __pitf_loglik array<double>, __pitf_letters long")

    # Grouped sums of the text-only probabilities; all other evidence derives from them.
    shares = (measured([]).where("__pitf_letters > 0").withColumn("p", _normal(F.concat(
        F.transform("__pitf_loglik", lambda x: x + float(np.log((1 - UNKNOWN) / n))), F.array(F.lit(float(np.log(UNKNOWN)))))))
              .groupBy("__pitf_declared", "__pitf_suffix", "__pitf_host").agg(*(F.sum(F.col("p")[i]).alias(f"n{i}") for i in range(n))))
    shares = materialise(shares, "shares")
    counts = [f"n{i}" for i in range(n)]
    overall = shares.agg(*(F.sum(c).alias(c) for c in counts)).first()
    overall = np.array([x or 0.0 for x in overall]) + 1.0 / n
    overall = overall / overall.sum()

    def total(columns: list[str]) -> Column:
        out = F.lit(0.0)
        for c in columns:
            out = out + F.col(c)
        return out

    suffixes = shares.groupBy("__pitf_suffix").agg(*(F.sum(c).alias(c) for c in counts)).select(
        "__pitf_suffix", F.array(*((F.col(c) + SUFFIX_WEIGHT * float(overall[i])) / (total(counts) + SUFFIX_WEIGHT)
                             for i, c in enumerate(counts))).alias("by_suffix"))
    hosts = shares.groupBy("__pitf_suffix", "__pitf_host").agg(*(F.sum(c).alias(c) for c in counts))
    hosts = hosts.join(suffixes.withColumnRenamed("__pitf_suffix", "s"), F.col("__pitf_suffix").eqNullSafe(F.col("s")))
    unknown = F.array(*(F.lit(float(x)) for x in overall))
    from_suffix = F.when(F.col("__pitf_suffix").isNull(), unknown).otherwise(F.col("by_suffix"))
    prior = F.array(*((F.col(c) + HOST_WEIGHT * from_suffix[i]) / (total(counts) + HOST_WEIGHT)
                      for i, c in enumerate(counts)))
    hosts = materialise(hosts.select(F.col("__pitf_suffix").alias("__pitf_s"), F.col("__pitf_host").alias("__pitf_h"),
                                     F.when(F.col("__pitf_host").isNull(), from_suffix).otherwise(prior).alias("__pitf_prior")), "hosts")
    said = shares.where("__pitf_declared IS NOT NULL").groupBy("__pitf_declared").agg(*(F.sum(c).alias(c) for c in counts))
    per_language = said.agg(*(F.sum(c).alias(c) for c in counts)).first()
    all_said = sum(x or 0.0 for x in per_language) or 1.0
    said = materialise(said.select(
        F.col("__pitf_declared").alias("__pitf_d"),
        F.array(*((F.col(c) + DECLARED_WEIGHT * total(counts) / all_said) / ((per_language[i] or 0.0) + DECLARED_WEIGHT)
                  for i, c in enumerate(counts)), total(counts) / all_said).alias("__pitf_stated")), "declared")

    fused = (measured(names)
             .join(hosts, F.col("__pitf_suffix").eqNullSafe(F.col("__pitf_s")) & F.col("__pitf_host").eqNullSafe(F.col("__pitf_h")), "left")
             .join(said, F.col("__pitf_declared") == F.col("__pitf_d"), "left"))
    stated = lambda i: F.coalesce(F.log(F.col("__pitf_stated")[i]), F.lit(0.0))
    logs = F.transform("__pitf_loglik", lambda x, i: x + F.log((1 - UNKNOWN) * F.coalesce(F.col("__pitf_prior"), unknown)[i]) + stated(i))
    fused = (fused.withColumn("__pitf_all", _normal(F.concat(logs, F.array(F.lit(float(np.log(UNKNOWN))) + stated(n)))))
             .withColumn("__pitf_posterior", F.slice("__pitf_all", 1, n)).withColumn("__pitf_top", F.array_max("__pitf_posterior")))
    letters = F.col("__pitf_letters") > 0
    sure = letters & (F.col("__pitf_top") >= F.col("__pitf_all")[n])
    best = F.element_at(F.array(*map(F.lit, model.names)), F.array_position("__pitf_posterior", F.col("__pitf_top")).cast("int"))
    return fused.select(*names, F.when(sure, best).otherwise(UNDETERMINED).alias("_language"),
                        F.when(letters, F.col("__pitf_top")).otherwise(0.0).alias("_probability"),
                        (sure & (F.col("__pitf_top") >= ACCEPTED)).alias("_accepted"))


def markup_language(text: Column) -> Column:
    """Primary tag of the ``lang`` attribute of a text's ``html`` element, NULL if there is none."""
    found = F.lower(F.regexp_extract(text, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})", 1))
    return F.when(text.contains("<html") | text.contains("<HTML"), F.nullif(found, F.lit("")))


def address_host(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def address_suffix(host: Column) -> Column:
    """What follows the last dot of a host, NULL without one."""
    return F.when(host.contains("."), F.substring_index(host, ".", -1))
