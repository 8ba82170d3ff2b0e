"""Divergence of the sources of each language by single-pass in-memory indexing.

Every task builds the postings of a block of documents in memory: by language and term, the number of documents and the
occurrences in each source. When memory is full, the block is given away as runs sorted by term, one for each hash
shard, cut into small chunks. A shard's chunks come back in the order of their first terms, and a heap merges the
open ones: a term is complete when the next chunk starts beyond it. Of the merged terms those in enough documents of
their language are kept. Distances of two sources are what all kept terms would give if neither held one, plus a correction
for each term that one of them holds; the corrections are added up in streams over blocks of sources.
"""
from __future__ import annotations

import heapq
import pickle
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitf.llm.remembered import spans
from pitf.llm.textcore import slices
from pitf.session import materialise

#: Postings (a term in a source), or bytes of text, that a task holds before it gives the block away; terms of a chunk of a run.
HELD_POSTINGS, HELD_BYTES, CHUNK = 600_000, 64 << 20, 2_000
#: Sources of a block of corrections, and terms whose corrections are taken at once.
SOURCES, TERMS = 256, 1_024
#: A term is a run of letters A-Z and a-z and of any code points beyond ASCII.
TERM = "[^\x00-\x40\x5B-\x60\x7B-\x7F]+"


class Block:
    """Postings of the documents since the last run."""

    def __init__(self) -> None:
        self.documents: dict[str, Counter] = defaultdict(Counter)
        self.occurrences: dict[str, dict[str, Counter]] = defaultdict(lambda: defaultdict(Counter))
        self.postings = self.read = 0

    def add(self, lang: str, source: str, terms: list[str], size: int) -> None:
        held = self.occurrences[lang][source]
        before = len(held)
        held.update(terms)
        self.documents[lang].update(set(terms))
        self.postings += len(held) - before
        self.read += size

    @property
    def full(self) -> bool:
        return self.postings > HELD_POSTINGS or self.read > HELD_BYTES

    def runs(self, shards: int) -> Iterator[tuple[int, str, str, bytes]]:
        """(shard, language, first term, chunk): each shard's terms of a language in order, cut into chunks."""
        for lang, documents in self.documents.items():
            terms = sorted(documents)
            number = dict(zip(terms, range(len(terms)), strict=True))
            held = self.occurrences[lang]
            term = np.fromiter(chain.from_iterable(map(number.__getitem__, x) for x in held.values()), np.int64)
            count = np.fromiter(chain.from_iterable(x.values() for x in held.values()), np.int64)
            source = np.repeat(np.arange(len(held), dtype=np.int32), [len(x) for x in held.values()])
            order = np.argsort(term, kind="stable")
            source, count = source[order], count[order]
            ends = np.cumsum(np.bincount(term, minlength=len(terms)))
            shard = np.fromiter((crc32(x.encode()) % shards for x in terms), np.int64, len(terms))
            names, docs = list(held), np.fromiter(map(documents.__getitem__, terms), np.int64, len(terms))
            by_shard = np.argsort(shard, kind="stable")
            for own in np.split(by_shard, np.flatnonzero(np.diff(shard[by_shard])) + 1):
                for start in range(0, len(own), CHUNK):
                    part = own[start:start + CHUNK]
                    length = np.diff(ends, prepend=0)[part]
                    at = spans(ends[part] - length, length)
                    chunk = ([terms[i] for i in part.tolist()], docs[part], np.cumsum(length), names, source[at], count[at])
                    yield int(shard[part[0]]), lang, chunk[0][0], pickle.dumps(chunk, pickle.HIGHEST_PROTOCOL)


def _indexer(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile(TERM).findall
        kinds = (pa.int32(), pa.string(), pa.string(), pa.binary())

        def given(block: Block) -> Iterator[pa.RecordBatch]:
            rows: list[tuple] = []
            size = 0
            for row in block.runs(shards):
                rows.append(row)
                size += len(row[3])
                if size > 4 << 20:
                    yield _batch(rows, kinds)
                    rows, size = [], 0
            if rows:
                yield _batch(rows, kinds)

        block = Block()
        for part in slices(batches, "text"):
            for text, lang, source in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                lower = text.encode().lower()  # of bytes: only A-Z changes
                block.add(lang, source, find(lower.decode()), len(lower))
                if block.full:
                    yield from given(block)
                    block = Block()
        yield from given(block)
    return run


def _batch(rows: list[tuple], kinds: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                      ["shard", "lang", "term", "chunk"])


def merged(chunks: Iterator[tuple[int, str, str, bytes]], least: int) -> Iterator[tuple[str, str, int, dict[str, int]]]:
    """(language, term, documents, occurrences by source) of the terms in at least so many documents, from chunks in the order of
    shard, language and first term. Open at a time is only what overlaps."""
    heap: list[tuple[str, int, int]] = []  # next term of an open chunk, the chunk's number, the term's place
    opened: dict[int, tuple] = {}

    def until(lang: str, first: str | None) -> Iterator[tuple[str, str, int, dict[str, int]]]:
        while heap and (first is None or heap[0][0] < first):
            term = heap[0][0]
            documents, parts = 0, []
            while heap and heap[0][0] == term:
                _, number, place = heap[0]
                chunk = opened[number]
                documents += chunk[1][place]
                parts.append((chunk, place))
                if place + 1 < len(chunk[0]):
                    heapq.heapreplace(heap, (chunk[0][place + 1], number, place + 1))
                else:
                    heapq.heappop(heap)
                    del opened[number]
            if documents >= least:
                counts: dict[str, int] = defaultdict(int)
                for (_, _, ends, names, sources, numbers), place in parts:
                    for at in range(ends[place - 1] if place else 0, ends[place]):
                        counts[names[sources[at]]] += numbers[at]
                yield lang, term, documents, counts

    current, serial = (0, ""), 0
    for shard, lang, term, stored in chunks:
        yield from until(current[1], term if (shard, lang) == current else None)
        current, serial = (shard, lang), serial + 1
        terms, documents, ends, names, sources, numbers = pickle.loads(stored)
        opened[serial] = (terms, documents.tolist(), ends.tolist(), names, sources.tolist(), numbers.tolist())
        heapq.heappush(heap, (terms[0], serial, 0))
    yield from until(current[1], None)


def _merger(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = (row for b in batches for row in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True))
        rows: list[tuple] = []
        held = 0

        def given():
            kinds = (pa.string(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                              ["lang", "term", "documents", "sources", "counts"])

        for lang, term, documents, counts in merged(chunks, least):
            rows.append((lang, term, documents, list(counts), list(counts.values())))
            held += len(counts)
            if held > 50_000:
                yield given()
                rows, held = [], 0
        if rows:
            yield given()
    return run


def kept_terms(docs: DataFrame, least_documents: int = 30, lang_col: str = "lang", source_col: str = "source",
               text_col: str = "text") -> DataFrame:
    """``lang``, ``term``, ``documents``, ``sources`` and ``counts`` (occurrences in each source that holds it) of every term in at
    least so many documents of its language. Nulls are empty strings; only A-Z are put in lower case."""
    spark = docs.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in (
        (text_col, "text"), (lang_col, "lang"), (source_col, "source"))))
    runs = texts.mapInArrow(_indexer(shards), "shard int, lang string, term string, chunk binary")
    return (runs.repartition(shards, "shard").sortWithinPartitions("shard", "lang", "term")
            .mapInArrow(_merger(least_documents), "lang string, term string, documents long, sources array<string>, counts array<long>"))


def _share(count: Column | str, total: str, terms: str, smoothing: int, scale: int) -> Column:
    """1 + floor(scale (count + smoothing) / (total + smoothing terms)), exact; null where nothing is kept."""
    count = F.col(count) if isinstance(count, str) else count
    over = (F.col(total) + smoothing * F.col(terms)).cast("decimal(20,0)")
    scaled = (count.cast("decimal(20,0)") + F.lit(smoothing)).cast("decimal(20,0)") * F.lit(scale).cast("decimal(17,0)")
    return F.when(over > 0, F.call_function("div", scaled, over).cast("long") + 1)


def _corrector():
    """Sums of corrections over streams sorted by language, blocks and shard; a stream starts with its sources (no term)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = None
        number: dict[str, int] = {}
        sources: list[tuple[str, int, int, int]] = []  # source, block, share without a count, kept terms of the language
        entries: list[tuple[int, int, int]] = []  # nth term, source, share
        term, nth = None, -1
        sums = rest = left = right = None

        def open_stream():
            """With the sources known: their base distances, counted in one shard only."""
            nonlocal sums, rest, left, right
            rest = np.array([x[2] for x in sources], np.int64)
            blocks = np.array([x[1] for x in sources])
            left, right = np.flatnonzero(blocks == key[1]), np.flatnonzero(blocks == key[2])
            sums = np.abs(rest[left][:, None] - rest[right][None, :])
            sums *= sources[0][3] if key[3] == 0 else 0

        def take():
            """Corrections of the terms at hand."""
            nonlocal entries, nth, term
            if entries:
                shares = np.repeat(rest[None, :], nth + 1, axis=0)
                at = np.array(entries, np.int64)
                shares[at[:, 0], at[:, 1]] = at[:, 2]
                other = shares[:, right]
                for i, source in enumerate(left.tolist()):
                    sums[i] += np.abs(shares[:, source:source + 1] - other).sum(axis=0)
                    sums[i] -= (nth + 1) * np.abs(rest[source] - rest[right])
            entries, nth, term = [], -1, None

        def given():
            if sums is None and sources:
                open_stream()
            take()
            a, b = np.meshgrid(left, right, indexing="ij")
            once = (a < b).ravel() if key[1] == key[2] else np.ones(a.size, bool)
            names = pa.array([x[0] for x in sources], pa.string())
            lang = pa.array([key[0]], pa.string()).take(pa.array(np.zeros(int(once.sum()), np.int64)))
            return pa.RecordBatch.from_arrays([lang, names.take(pa.array(a.ravel()[once])), names.take(pa.array(b.ravel()[once])),
                                               pa.array(sums.ravel()[once])], ["lang", "a", "b", "value"])

        for batch in batches:
            for lang, low, high, shard, word, source, block, share, kept in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (lang, low, high, shard) != key:
                    if key is not None:
                        yield given()
                    key, number, sources, sums = (lang, low, high, shard), {}, [], None
                if word is None:
                    number[source] = len(sources)
                    sources.append((source, block, share, kept))
                    continue
                if sums is None:
                    open_stream()
                if word != term:
                    if nth + 1 == TERMS:
                        take()
                    term, nth = word, nth + 1
                entries.append((nth, number[source], share))
        if key is not None:
            yield given()
    return run


def pair_distances(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """``lang``, ``a``, ``b`` and ``value``, the sum of |share of a - share of b| over all kept terms, for each two sources once.

    ``groups``: lang, source, rest (the share of a term without a count), kept (number of kept terms), parts (blocks of sources of
    the language); ``shares``: lang, term, source, share of each term in a source that holds it. Streams are shards of terms
    for each two blocks of sources: a source goes to as many streams as there are blocks.
    """
    spark = groups.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    block = F.pmod(F.xxhash64("source"), F.col("parts")).cast("int")
    streams = F.ceil(F.lit(2 * tasks) / (F.col("parts") * (F.col("parts") + 1))).cast("int")
    placed = (groups.withColumn("block", block).withColumn("streams", streams)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))))
    ends = [F.least("block", "other").cast("int").alias("low"), F.greatest("block", "other").cast("int").alias("high")]
    columns = ["lang", "low", "high", "shard", "term", "source", "block", "share", "kept"]
    heads = (placed.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("streams") - 1)))
             .select("lang", *ends, "shard", F.lit(None).cast("string").alias("term"), "source", "block", F.col("rest").alias("share"), "kept"))
    entries = (shares.join(placed.select("lang", "source", "block", "other", "streams", "kept"), ["lang", "source"])
               .withColumn("shard", F.pmod(F.xxhash64("term"), F.col("streams")).cast("int"))
               .select("lang", *ends, "shard", "term", "source", "block", "share", "kept"))
    dealt = (heads.select(columns).unionByName(entries.select(columns))
             .repartition(tasks, "lang", "low", "high", "shard")
             .sortWithinPartitions("lang", "low", "high", "shard", F.asc_nulls_first("term"), "source"))
    return (dealt.mapInArrow(_corrector(), "lang string, a string, b string, value long")
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))


def audit(docs: DataFrame, least_documents: int = 30, smoothing: int = 5, scale: int = 1_000_000_000, top: int = 50,
          lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """How the sources of each language differ: ``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank``.

    A term's share in a source, or the whole language, is 1 + floor(scale (count + smoothing) / (all counts + smoothing kept terms)).
    Part ``pair``: every other source of the language with the sum of the shares' differences over all kept terms (0 if none is
    kept), all ranks. Part ``term``: the ``top`` terms of the source whose share exceeds the language's most. Ranks go by value
    descending, then item by code points. Null language, source or text is an empty string, a language or source without
    terms is one nevertheless; repeated rows count each; other columns are ignored; an empty table gives no rows.
    """
    kept = materialise(kept_terms(docs, least_documents, lang_col, source_col, text_col), "kept")
    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"))]
    all_groups = docs.select(*named).distinct()
    counts = kept.select("lang", "term", F.expr("aggregate(counts, 0L, (a, b) -> a + b)").alias("lang_count"),
                         F.explode(F.arrays_zip("sources", "counts")).alias("x")).select(
        "lang", "term", "lang_count", F.col("x.sources").alias("source"), F.col("x.counts").alias("n"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum(F.expr("aggregate(counts, 0L, (a, b) -> a + b)")).alias("lang_total"))
    sizes = all_groups.groupBy("lang").agg(F.ceil(F.count("*") / SOURCES).cast("int").alias("parts"))
    zero = F.lit(0).cast("long")
    groups = (all_groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").join(sizes, "lang")
              .select("lang", "source", "parts", *(F.coalesce(c, zero).alias(c) for c in ("total", "kept", "lang_total")))
              .withColumn("rest", F.coalesce(_share(zero, "total", "kept", smoothing, scale), zero)))
    groups = materialise(groups, "groups")
    shares = materialise(
        counts.join(groups.drop("parts", "rest"), ["lang", "source"])
        .select("lang", "source", "term", _share("n", "total", "kept", smoothing, scale).alias("share"),
                _share("lang_count", "lang_total", "kept", smoothing, scale).alias("usual")), "shares")
    pairs = pair_distances(groups, shares.select("lang", "source", "term", "share"))
    both = pairs.select("lang", "value", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                                                           F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("x"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    out = ["lang", "source", "part", "item", "value", "rank"]
    pair = both.select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value").withColumn("rank", F.row_number().over(order))
    term = (shares.where("share > usual")
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("share") - F.col("usual")).alias("value"))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))
    return pair.select(out).unionByName(term.select(out))
