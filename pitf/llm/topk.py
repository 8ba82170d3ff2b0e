"""Exact top-k by inner product with M-trees.

Vectors become integers. Largest inner product is nearest neighbour after one more coordinate is
added to every candidate that makes all their norms equal: |q - x|^2 = |q|^2 + R^2 - 2 q.x. In that metric each
shard of the table is an M-tree of pages: a leaf page holds vectors with their stored distances to the page's
centre, an inner page holds centres of pages below with covering radii and their stored distances to its own
centre. A block of queries walks the pages of a shard best first by the bound distance - radius; each query skips a page or
vector, without computing its distance, where |d(query, parent) - d(parent, it)| - radius exceeds its worst kept distance.
"""
from __future__ import annotations

import heapq
import pickle
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitf.session import materialise

#: Vectors in a leaf page, entries of an inner page, vectors of a shard, queries of a block.
LEAF = 128
FAN_OUT = 32
SHARD = 20_000
QUERY_BLOCK = 4096
#: Slack on distances, which are floating-point; scores are integers.
SLACK = 1e-6


@dataclass
class Page:
    centre: np.ndarray
    to_centre: np.ndarray  # stored distance of each entry to the centre
    radii: np.ndarray | None  # covering radius of each entry; None in a leaf
    entries: np.ndarray  # leaf: vectors; inner page: centres of the pages below
    rows: np.ndarray | None  # leaf: row numbers of the vectors
    below: list | None
    norm: float = 0.0  # of the root: common squared norm of all candidates

    @property
    def radius(self) -> float:
        return float((self.to_centre if self.radii is None else self.to_centre + self.radii).max(initial=0.0))


    def plain(self) -> tuple:
        """The tree as tuples of arrays, to be stored."""
        return (self.centre, self.to_centre, self.radii, self.entries, self.rows,
                self.below and [p.plain() for p in self.below], self.norm)


def _page(stored: tuple) -> Page:
    return Page(*stored[:5], stored[5] and [_page(x) for x in stored[5]], stored[6])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(((a - b) ** 2).sum(axis=-1), 0))


def build(points: np.ndarray, rows: np.ndarray, draw: np.random.Generator) -> Page:
    """A page over the points: split among far-apart promoted points until they fit a leaf."""
    centre = points.mean(axis=0)
    if len(points) <= LEAF:
        return Page(centre, _distances(points, centre), None, points, rows, None)
    parts = min(FAN_OUT, -(-len(points) // LEAF) + 1)
    chosen = [int(draw.integers(len(points)))]
    nearest = _distances(points, points[chosen[0]])
    owner = np.zeros(len(points), np.int64)
    for k in range(1, parts):
        chosen.append(int(nearest.argmax()))
        far = _distances(points, points[chosen[-1]])
        owner[far < nearest] = k
        nearest = np.minimum(nearest, far)
    if nearest.max() == 0 or np.bincount(owner).max() == len(points):  # all alike: any split will do
        owner = np.arange(len(points)) % parts
    below = [build(points[owner == k], rows[owner == k], draw) for k in range(parts) if (owner == k).any()]
    centres = np.stack([p.centre for p in below])
    return Page(centre, _distances(centres, centre), np.array([p.radius for p in below]), centres, None, below)


class Block:
    """A block of queries and the k best rows found for each so far: scores, ids and row numbers, best first."""

    def __init__(self, queries: np.ndarray, own: np.ndarray, least: np.ndarray, k: int):
        self.exact, self.own, self.least = queries.astype(np.float64), own, least.astype(np.float64)
        self.points = np.concatenate((self.exact, np.zeros((len(queries), 1))), axis=1)
        self.square = (self.exact ** 2).sum(axis=1)
        self.scores = np.full((len(queries), k), -np.inf)
        self.ids = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.rows = np.full((len(queries), k), -1)

    def worst(self, norm: float) -> np.ndarray:
        """Distance that a better row must not exceed, from the k-th score or the one carried from another shard."""
        kth = np.maximum(self.scores[:, -1], self.least)
        return np.sqrt(np.maximum(self.square + norm - 2.0 * kth, 0.0)) + SLACK

    def distances(self, asked: np.ndarray, entries: np.ndarray) -> np.ndarray:
        square = self.square[asked][:, None] + (entries ** 2).sum(axis=1)[None, :] - 2.0 * self.points[asked] @ entries.T
        return np.sqrt(np.maximum(square, 0.0))

    def offer(self, asked: np.ndarray, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Exact scores of some rows (products of integers, exact in double precision below 2^53)."""
        scores = self.exact[asked] @ vectors.T.astype(np.float64)
        scores[self.own[asked][:, None] == rows[None, :]] = -np.inf
        better = scores.max(axis=1) >= np.maximum(self.scores[asked, -1], self.least[asked])
        asked, scores = asked[better], scores[better]
        scores = np.concatenate((self.scores[asked], scores), axis=1)
        ids = np.concatenate((self.ids[asked], np.broadcast_to(ids, (len(asked), len(ids)))), axis=1)
        rows = np.concatenate((self.rows[asked], np.broadcast_to(rows, (len(asked), len(rows)))), axis=1)
        best = np.lexsort((rows, ids, -scores), axis=-1)[:, :self.scores.shape[1]]
        for kept, new in ((self.scores, scores), (self.ids, ids), (self.rows, rows)):
            kept[asked] = np.take_along_axis(new, best, axis=1)


def search(root: Page, block: Block, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> int:
    """Walk a shard best first for a block of queries: the page nearest to any query comes next, and with it go only the
    queries that may find something there. Returns how many distances and scores were computed."""
    everyone = np.arange(len(block.exact))
    away = block.distances(everyone, root.centre[None, :])[:, 0]
    todo = [(0.0, 0, root, everyone, np.zeros(len(everyone)), away)]
    tie, computed = 0, len(everyone)
    while todo:
        _, _, page, asked, bound, away = heapq.heappop(todo)
        worst = block.worst(root.norm)
        stay = bound <= worst[asked]
        asked, away = asked[stay], away[stay]
        if not len(asked):
            continue
        # Stored distances to the centre rule entries out, for each query, before anything is computed.
        radii = 0.0 if page.radii is None else page.radii
        near = np.abs(away[:, None] - page.to_centre[None, :]) - radii <= worst[asked][:, None]
        entries = np.flatnonzero(near.any(axis=0))
        own = near.any(axis=1)
        asked, near = asked[own], near[own][:, entries]
        if not len(asked):
            continue
        computed += len(asked) * len(entries)
        if page.rows is not None:
            at = page.rows[entries]
            block.offer(asked, vectors[at], ids[at], rows[at])
            continue
        distance = block.distances(asked, page.entries[entries])
        least = np.maximum(distance - page.radii[entries][None, :], 0.0)
        near &= least <= worst[asked][:, None]
        for i, entry in enumerate(entries.tolist()):
            who = np.flatnonzero(near[:, i])
            if len(who):
                tie += 1
                heapq.heappush(todo, (float(least[who, i].min()), tie, page.below[entry], asked[who], least[who, i], distance[who, i]))
    return computed


def integers(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component, x as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def _pages(k: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        """One shard as a pickled tree. Equal vectors are one point with their k + 1 first rows by id: no others can be
        among the best k of any query, which leaves out itself only."""
        vectors = np.stack(group["vector"].to_numpy()).astype(np.int64)
        ids, rows = group["vec_id"].to_numpy(), group["row"].to_numpy()
        order = np.lexsort((rows, ids, *vectors.T[::-1]))
        vectors, ids, rows = vectors[order], ids[order], rows[order]
        fresh = np.concatenate(([True], (vectors[1:] != vectors[:-1]).any(axis=1)))
        place = np.arange(len(ids)) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
        vectors, ids, rows = vectors[place <= k], ids[place <= k], rows[place <= k]
        norms = (vectors.astype(float) ** 2).sum(axis=1)
        points = np.concatenate((vectors, np.sqrt(norms.max() - norms)[:, None]), axis=1)
        root = build(points, np.arange(len(ids)), np.random.default_rng(5))
        root.norm = float(norms.max())
        return pd.DataFrame({"shard": group["shard"].iloc[:1], "width": group["width"].iloc[:1],
                             "tree": [pickle.dumps((root.plain(), vectors, ids, rows))]})
    return run


def _searched(k: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        columns = ["asked", "query_id", "row", "vec_id", "score"]
        if left.empty or right.empty:
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in columns})
        stored, vectors, ids, rows = pickle.loads(left["tree"].iloc[0])
        block = Block(np.stack(right["vector"].to_numpy()), right["row"].to_numpy(),
                      right["least"].fillna(-np.inf).to_numpy(np.float64), k)
        search(_page(stored), block, vectors, ids, rows)
        query, place = np.nonzero(block.scores > -np.inf)
        return pd.DataFrame({"asked": right["row"].to_numpy()[query], "query_id": right["vec_id"].to_numpy()[query],
                             "row": block.rows[query, place], "vec_id": block.ids[query, place],
                             "score": block.scores[query, place].astype(np.int64)})[columns].astype("int64")
    return run


def top_k(table: DataFrame, query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = 64) -> DataFrame:
    """For each row where ``query``: its ``k`` highest integer inner products with other rows' vectors, as ``query_id``,
    ``rank`` (from 1), ``vec_id``, ``score``; ties go to the smaller id, fewer rows where there are fewer.

    Rows with a null id, a null vector or a null or non-finite component take no part; vectors meet
    those of equal length only; scores must stay below 2^53. Every row is a candidate, and a query if asked, of its own, also where
    ids repeat; it leaves out itself only. Other columns are ignored; an empty table gives no rows.

    Shards are hashes of the row, so any number of equal vectors is spread evenly. Queries go to every shard in blocks, the
    trees are found once per block; each pair of them returns k rows per query. The first shard is searched before the
    others, which start with the k-th score found there.
    """
    finite = F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = (table.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & finite)
             .withColumn("_query", query)
             .select(F.col(id_col).cast("long").alias("vec_id"), integers(F.col(vector_col), scale).alias("vector"),
                     F.coalesce("_query", F.lit(False)).alias("asked"))
             .withColumn("width", F.size("vector")).where("width > 0").withColumn("row", F.monotonically_increasing_id()))
    valid = materialise(valid, "vectors")
    rows, asked = valid.agg(F.count("*"), F.count_if("asked")).first()
    shards, blocks = max(1, -(-rows // SHARD)), max(1, -(-asked // QUERY_BLOCK))
    trees = materialise(
        valid.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
        .select("shard", "width", "vec_id", "row", "vector").groupBy("width", "shard")
        .applyInPandas(_pages(k), "shard int, width int, tree binary"), "trees")
    queries = (valid.where("asked").select("width", "vec_id", "row", "vector")
               .withColumn("block", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).cast("int")))
    keys = ["width", "shard", "block"]

    def searched(those: Column, asking: DataFrame) -> DataFrame:
        placed = trees.where(those).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        sent = asking.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where(those)
        return placed.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInPandas(
            _searched(k), "asked long, query_id long, row long, vec_id long, score long")

    first = F.col("shard") == 0
    found = searched(first, queries.withColumn("least", F.lit(None).cast("double")))
    if shards > 1:
        found = materialise(found, "first")
        kth = (found.groupBy(F.col("asked").alias("row")).agg(F.count("*").alias("n"), F.min("score").cast("double").alias("least"))
               .where(F.col("n") == k).select("row", "least"))
        found = found.unionByName(searched(~first, queries.join(kth, "row", "left")))
    order = Window.partitionBy("asked").orderBy(F.desc("score"), "vec_id", "row")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
