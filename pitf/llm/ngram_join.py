"""Jaccard join on word shingles by T-occurrence search.

A document with n distinct shingles must share at least T = ceil(share * n) of them with every
partner. DivideSkip splits the inverted lists of its shingles: the n - T + 1 rarest ("short")
are merged, the other L = T - 1 ("long") are only probed. Every partner occurs in at least
T - L = 1 of the merged lists, whatever order decides which shingles count as rare, as long as
all documents use the same one. Here rare means: not among the frequent shingles, then by hash.

The lists are built by a shuffle on the shingle and never expanded into pairs. All lists with the same
most central document (hub) form a pool, dealt out in blocks. A first search merges short lists only, those of the
hub before those of the blocks, and keeps the documents for which they leave a partner possible; for those alone whole sets are formed. They
are compared with their hub and contracted into components; then each document outside its pool's main component
searches the pool by DivideSkip: short lists merged, documents with T - L occurrences binary-probed in
the long ones, those that reach the overlap linked. A group of copies is thus never paired with itself, and what is returned is
the links' components, which is what the groups are.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitf.llm.components import connected
from pitf.llm.textcore import shingle_sets, slices, text_bytes
from pitf.session import materialise

#: Frequent shingles put last in the order: at most so many, each in at least so many lists' documents.
#: They only decide which lists are merged, never which pairs link, so their number bounds a broadcast only.
FREQUENT = 100_000
FREQUENT_FROM = 8
#: Documents in one block of a pool, the unit of the search in memory.
POOL_BLOCK = 1024
#: Weight in the DivideSkip choice of how many lists are long, T / (weight * log2(longest) + 1): merging is cheap here.
MERGE_WEIGHT = 1.0


def needed(n, percent: int):
    """Least overlap with any partner of a set of n shingles."""
    return -(-percent * n // 100)


def _order_keys(hashes: np.ndarray, late: np.ndarray | None = None) -> np.ndarray:
    """Place of each shingle in the common order as a positive number: 62 bits of its hash, frequent ones behind."""
    keys = (hashes >> np.uint64(2)).view(np.int64)
    return keys if late is None else keys | late.astype(np.int64) << 62


def _set_id(one: np.ndarray) -> bytes:
    """128 bits that stand for a whole set."""
    return hashlib.blake2b(one.tobytes(), digest_size=16).digest()


def _summaries(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sizes, ids, prefixes = [], [], []
            for one in shingle_sets(*text_bytes(batch.column(1)), width):
                n = len(one)
                sizes.append(n)
                ids.append(_set_id(one))
                prefixes.append(_order_keys(one[:n - needed(n, percent) + 1] if n else one))
            ends = np.cumsum([0, *map(len, prefixes)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(prefixes)))],
                ["doc_id", "n_shingles", "set_id", "short"])
    return run


def _among(some: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys are in a sorted array."""
    return some[np.minimum(np.searchsorted(some, keys), len(some) - 1)] == keys


def _short_lists(width: int, percent: int, frequent):
    """New short lists of the sets that have frequent shingles among their first ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = frequent.value
        for batch in slices(batches, "text"):
            ids, lists = [], []
            for one in shingle_sets(*text_bytes(batch.column(1)), width):
                size = len(one) - needed(len(one), percent) + 1
                keys = _order_keys(one)
                if len(one) and _among(last, keys[:size]).any():
                    late = _among(last, keys)
                    ids.append(_set_id(one))
                    lists.append(np.sort(_order_keys(one, late))[:size].tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.binary()), pa.array(lists, pa.list_(pa.int64()))], ["set_id", "short"])
    return run


def _whole_sets(width: int):
    """All shingles of the wanted sets; a row whose id is also used for another text is passed over."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [(wanted, one.tobytes()) for wanted, one in
                     zip(batch.column(0).to_pylist(), shingle_sets(*text_bytes(batch.column(1)), width), strict=True)
                     if _set_id(one) == wanted]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in found], pa.binary()) for i in (0, 1)], ["set_id", "shingles"])
    return run


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlap of two sorted sets: binary search of the smaller set's shingles in the larger."""
    for batch in batches:
        shared, total = [], []
        for a, b in zip(batch.column(2), batch.column(3), strict=True):
            x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
            if len(x) > len(y):
                x, y = y, x
            at = np.searchsorted(y, x)
            shared.append(int((y[np.minimum(at, len(y) - 1)] == x).sum()))
            total.append(len(x) + len(y))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(shared, pa.int64()), pa.array(total, pa.int64())],
            ["a", "b", "shared", "total"])


def _overlaps(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link, written once. A set missing in ``sets`` has no partner."""
    with_a = pairs.join(sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("sa")), "a")
    both = with_a.join(sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("sb")), "b")
    shared = both.select("a", "b", "sa", "sb").mapInArrow(_probe, "a binary, b binary, shared long, total long")
    return materialise(shared.where(100 * F.col("shared") >= percent * (F.col("total") - F.col("shared"))).select("a", "b"),
                       "links")


def _inverted(members: list[tuple]) -> tuple:
    """Merged inverted lists of (set_id, size, short list) rows: sizes, keys in order, owners, last keys, ids."""
    lists = [x[2] for x in members]
    keys = np.concatenate(lists)
    order = np.argsort(keys, kind="stable")
    owners = np.repeat(np.arange(len(lists)), [len(x) for x in lists])[order]
    return (np.array([x[1] for x in members]), keys[order], owners, np.array([x[-1] for x in lists]),
            np.array([x[0] for x in members], object))


def _candidates(set_id: bytes, n: int, one: np.ndarray, index: tuple, percent: int) -> np.ndarray:
    """Indexed sets that the merged short lists leave as partners of a set of ``n`` shingles with short list ``one``.

    Of two sets, all shingles up to the earlier end of their short lists are known: what only one has there is not
    shared, which bounds the overlap."""
    sizes, keys, owners, lasts, ids = index
    shared = np.bincount(np.concatenate([owners[i:j] for i, j in zip(
        np.searchsorted(keys, one, "left"), np.searchsorted(keys, one, "right"), strict=True)]), minlength=len(sizes))
    mine = np.searchsorted(one, lasts, "right") - shared
    theirs = np.bincount(owners[:np.searchsorted(keys, one[-1], "right")], minlength=len(sizes)) - shared
    most = np.minimum(n - mine, sizes - theirs)
    return np.flatnonzero((shared > 0) & (most * (100 + percent) >= percent * (n + sizes)) & (ids != set_id))


def _pool_rows(found: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.binary()) for i in (0, 1)], ["pool", "set_id"])


def _near_hub(percent: int):
    """Members of a block that may link with their pool's hub. Rows come ordered by pool and block, the hub first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub = None
        for batch in batches:
            found = []
            for pool, _, member, set_id, n, short in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                one = np.array(short, np.int64)
                if not member:
                    hub = _inverted([(set_id, n, one)])
                elif len(_candidates(set_id, n, one, hub, percent)):
                    found.append((pool, set_id))
            yield _pool_rows(found)
    return run


def _possible(percent: int):
    """Members of a block's pool that the merged short lists leave a possible partner.

    Rows come ordered by pool and block, the block's members first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, members, index, alive = None, [], None, None

        def finish():
            """The members search their own block too."""
            mask = alive if alive is not None else np.zeros(len(members), bool)
            if len(members) > 1:
                known = index or _inverted(members)
                for i, (set_id, n, one) in enumerate(members):
                    hit = _candidates(set_id, n, one, known, percent)
                    if len(hit):
                        mask[hit] = mask[i] = True
            return [(at[0], members[i][0]) for i in np.flatnonzero(mask)]

        for batch in batches:
            found = []
            for pool, block, searching, set_id, n, short in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (pool, block) != at:
                    found += finish() if at else []
                    at, members, index, alive = (pool, block), [], None, None
                one = np.array(short, np.int64)
                if not searching:
                    members.append((set_id, n, one))
                    continue
                if not members:
                    continue
                if index is None:
                    index, alive = _inverted(members), np.zeros(len(members), bool)
                hit = _candidates(set_id, n, one, index, percent)
                if len(hit):
                    alive[hit] = True
                    found.append((pool, set_id))
            yield _pool_rows(found)
        if at:
            yield _pool_rows(finish())
    return run


def _occurrence_search(one: np.ndarray, least: int, keys: np.ndarray, owners: np.ndarray, n: int) -> np.ndarray:
    """Overlap of ``one`` with each of ``n`` indexed sets, exact where it reaches ``least``, else below it.

    ``keys`` holds the shingles of all inverted lists in order, ``owners`` the sets, ascending in each list.
    """
    lo, hi = np.searchsorted(keys, one, "left"), np.searchsorted(keys, one, "right")
    order = np.argsort(hi - lo, kind="stable")
    lo, hi = lo[order], hi[order]
    longest = int(hi[-1] - lo[-1])
    n_long = min(least - 1, int(least / (MERGE_WEIGHT * np.log2(longest + 2) + 1)))
    n_short = len(one) - n_long
    merged = np.concatenate([owners[i:j] for i, j in zip(lo[:n_short], hi[:n_short], strict=True)])
    counts = np.bincount(merged, minlength=n)  # the merge, counting in place of a heap
    found = np.flatnonzero(counts >= least - n_long)
    for k in range(n_short, len(one)):
        if not len(found):
            break
        owned = owners[lo[k]:hi[k]]
        at = np.searchsorted(owned, found)
        counts[found] += owned[np.minimum(at, len(owned) - 1)] == found if len(owned) else 0
        found = found[counts[found] + len(one) - 1 - k >= least]
    out = np.zeros(n, np.int64)
    out[found] = counts[found]
    return out


def _pool_links(percent: int):
    """One link from every searching set to each other component that it links with, per block of a pool.

    Rows come ordered by pool and block, the members first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, members, index = None, [], None
        for batch in batches:
            links = []
            for pool, block, searching, set_id, component, shingles in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (pool, block) != at:
                    at, members, index = (pool, block), [], None
                one = np.frombuffer(shingles, np.uint64)
                if not searching:
                    members.append((set_id, component, one))
                    continue
                if not members:  # the hash left this block empty
                    continue
                if index is None:
                    sizes = np.array([len(x[2]) for x in members])
                    keys = np.concatenate([x[2] for x in members])
                    order = np.argsort(keys, kind="stable")
                    names = {c: i for i, c in enumerate(dict.fromkeys(x[1] for x in members))}
                    index = keys[order], np.repeat(np.arange(len(members)), sizes)[order], sizes, np.array(
                        [names[x[1]] for x in members]), names
                keys, owners, sizes, parts, names = index
                shared = _occurrence_search(one, needed(len(one), percent), keys, owners, len(members))
                hit = (100 * shared >= percent * (len(one) + sizes - shared)) & (parts != names.get(component, -1))
                hit = np.flatnonzero(hit)
                links += [(set_id, members[i][0]) for i in hit[np.unique(parts[hit], return_index=True)[1]]]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.binary()) for i in (0, 1)], ["a", "b"])
    return run


def _placed(member: DataFrame) -> DataFrame:
    """``blocks`` of each member's pool and its ``own`` one."""
    blocks = member.groupBy("pool").agg(F.ceil(F.count("*") / POOL_BLOCK).cast("int").alias("blocks"))
    return member.join(blocks, "pool").withColumn("own", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))


def _in_blocks(placed: DataFrame, searching) -> DataFrame:
    """Each member in its block of the pool, and again in the blocks that it searches where ``searching``."""
    visits = placed.where(searching).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return (placed.withColumn("block", F.col("own")).withColumn("searching", F.lit(False))
            .unionByName(visits.withColumn("searching", F.lit(True))))


def _possible_members(member: DataFrame, short: DataFrame, percent: int) -> DataFrame:
    """Members (pool, set_id) that short lists leave a possible partner in their pool.

    In pools of several blocks those that may link with the hub are settled by it alone, in one row each; only the
    others search all blocks, so a large group of near copies costs rows in proportion to its size."""
    placed = materialise(_placed(member), "placed")
    large = placed.where("blocks > 1")
    hubs = (large.select("pool", "blocks").distinct()
            .select("pool", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
            .withColumn("set_id", F.col("pool")).withColumn("searching", F.lit(False)))
    beside = hubs.unionByName(large.select("pool", F.col("own").alias("block"), "set_id", F.lit(True).alias("searching")))
    columns, found = ["set_id", "n_shingles", "short"], "pool binary, set_id binary"
    near = materialise(_dealt(beside.join(short, "set_id"), columns).mapInArrow(_near_hub(percent), found), "near")
    marked = placed.join(near.withColumn("near", F.lit(True)), ["pool", "set_id"], "left")
    listed = (_in_blocks(marked, F.col("near").isNull() & (F.col("blocks") > 1))
              .where("NOT searching OR own <> block").join(short, "set_id"))
    return materialise(_dealt(listed, columns).mapInArrow(_possible(percent), found).unionByName(near).distinct(), "alive")


def _dealt(rows: DataFrame, columns: list[str]) -> DataFrame:
    return (rows.select("pool", "block", "searching", *columns).repartition("pool", "block")
            .sortWithinPartitions("pool", "block", "searching"))


def link_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    percent: int = 80) -> DataFrame:
    """One row per document: ``id_col``, ``n_shingles``, ``set_id`` (equal for equal sets), ``component_id``.

    Words are runs of characters other than space and \\x09-\\x0D with A-Z lowered. Two documents
    link when 100 * shared >= percent * union over distinct ``width``-word shingles;
    ``component_id`` is the smallest id reachable by links.

    Nulls: a null or empty text has an empty set, links with nothing and is its own component. A row
    with a null id links with nothing either and its ``component_id`` is null. Repeated rows and
    ids stay as they are; an id used for two texts stands for both. Other columns are ignored.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"doc_id {texts.schema['doc_id'].dataType.simpleString()}"
    summaries = materialise(
        texts.mapInArrow(_summaries(width, percent), f"{schema}, n_shingles long, set_id binary, short array<long>"),
        "summaries")
    named = summaries.where("doc_id IS NOT NULL AND n_shingles > 0")
    sets = (named.groupBy("set_id").agg(F.min(F.struct("doc_id", "n_shingles", "short")).alias("least"))
            .select("set_id", "least.*"))
    sets = materialise(sets, "sets")

    frequent = [row[0] for row in (
        sets.select(F.explode("short").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("n"))
        .where(F.col("n") >= FREQUENT_FROM).orderBy(F.desc("n"), "shingle").limit(FREQUENT).select("shingle").collect())]
    short = sets.select("set_id", "n_shingles", "short")
    if frequent:
        shared = spark.sparkContext.broadcast(np.sort(np.array(frequent, np.int64)))
        again = (texts.where("doc_id IS NOT NULL")
                 .mapInArrow(_short_lists(width, percent, shared), "set_id binary, short array<long>")
                 .groupBy("set_id").agg(F.min("short").alias("again")))
        short = (short.join(again, "set_id", "left")
                 .select("set_id", "n_shingles", F.coalesce("again", "short").alias("short")))

    # A list's documents by size: whoever has no neighbour of a size that can link has no partner in the list.
    short = materialise(short, "short")
    in_list = Window.partitionBy("shingle").orderBy("n_shingles")
    size, before, after = (F.col("n_shingles"), F.lag("n_shingles").over(in_list), F.lead("n_shingles").over(in_list))
    posted = materialise(
        short.select("set_id", "n_shingles", F.explode("short").alias("shingle"))
        .withColumn("fits", (100 * before >= percent * size) | (100 * size >= percent * after)).where("fits").drop("fits"),
        "posted")
    # The hub of a list, the most central of its documents, names the pool: a text that others were copied from shares
    # nearly all its short lists; a copy has some of its own.
    central = posted.groupBy("set_id").agg((F.count("*") / F.max("n_shingles")).alias("weight"))
    hubs = posted.join(central, "set_id").groupBy("shingle").agg(F.max(F.struct("weight", "set_id")).alias("top"))
    member = materialise(posted.join(hubs.select("shingle", F.col("top.set_id").alias("pool")), "shingle")
                         .select("pool", "set_id").distinct(), "pools")
    alive = _possible_members(member, short, percent)

    component = None
    if not alive.isEmpty():
        wanted = alive.select("set_id").distinct().join(sets.select("set_id", "doc_id"), "set_id")
        whole = materialise(
            texts.join(wanted, "doc_id").select("set_id", "text")
            .mapInArrow(_whole_sets(width), "set_id binary, shingles binary").dropDuplicates(["set_id"]), "shingles")
        to_hub = (alive.where("pool <> set_id")
                  .select(F.least("pool", "set_id").alias("a"), F.greatest("pool", "set_id").alias("b")).distinct())
        links = _overlaps(to_hub, whole, percent)
        component = connected(links)
        at = (alive.join(component, "set_id", "left").withColumn("component", F.coalesce("component", "set_id")))
        main = (at.groupBy("pool", "component").agg(F.count("*").alias("n")).groupBy("pool")
                .agg(F.max(F.struct("n", "component")).alias("top"), F.count("*").alias("parts")).where("parts > 1")
                .select("pool", F.col("top.component").alias("main")))
        blocked = _in_blocks(_placed(at.join(main, "pool")), F.col("component") != F.col("main")).join(whole, "set_id")
        found = _dealt(blocked, ["set_id", "component", "shingles"]).mapInArrow(_pool_links(percent), "a binary, b binary")
        component = connected(links.unionByName(materialise(found, "links")))

    labelled = sets.select("set_id", F.col("doc_id").alias("least")).withColumn("component", F.col("set_id"))
    if component is not None:
        labelled = (sets.select("set_id", F.col("doc_id").alias("least")).join(component, "set_id", "left")
                    .withColumn("component", F.coalesce("component", "set_id")))
    smallest = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    by_set = labelled.join(smallest, "component").select("set_id", "component_id")
    found = summaries.select("doc_id", "n_shingles", "set_id").join(by_set, "set_id", "left")
    alone = F.col("n_shingles") == 0
    return found.select(
        F.col("doc_id").alias(id_col), "n_shingles", "set_id",
        F.when(F.col("doc_id").isNull(), F.lit(None)).when(alone, F.col("doc_id"))
        .otherwise(F.col("component_id")).alias("component_id"))
