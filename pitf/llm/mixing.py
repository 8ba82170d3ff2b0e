"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a share of the words wanted in all; a document of a source with share r (target over
size) is wanted r times: floor(r) whole copies and one more with probability r - floor(r). Those
probabilities are rounded together. Two documents a and b with fractional probabilities move mass between each
other, d words from one to the other, until one of them is at 0 or 1; the direction is drawn so that
each probability keeps its mean. The words wanted of the source stay exactly the same, and at most one fractional
document per source is left for a last draw.

The pairing runs as a reduction tree: buckets of a source's documents (by hash), each folded by one
``aggregate`` expression, hand one fractional document on to the next level, where up to ``FAN_IN``
of them meet. A source of any size is spread over as many buckets as it needs.
"""
from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitf.operators.prefix import running_totals
from pitf.session import materialise

#: Documents (or residuals) folded in one bucket of the reduction tree.
FAN_IN = 128
WORD = r"[^\x20\x09-\x0D]+"
_ITEM = "struct<item:bigint, size:bigint, p:double>"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5,
                   most: float = 2.0) -> DataFrame:
    """``source``, ``source_size``, ``target`` from rows (source, size).

    Sources by code point, NULL last, weigh ``weights`` repeating and share ``share`` times all words by
    weight; none gets more than ``most`` times its own, and what it leaves is shared again by weight. So every target is
    min(most * size, level * weight) with one level for all. Sources are ordered by how early they reach
    their limit; the level follows from the running sums of that order. Both orders are
    distributed running totals, so the number of sources is not bounded by a task.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn(
        "missing", F.col("source").isNull())
    ranked = running_totals(per_source, [("missing", True), ("source", True)], {"one": F.lit(1)})
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("one_cum") - 1) % len(weights) + 1).cast("int"))
    ranked = ranked.select("source", "missing", "source_size", weight.alias("weight")).withColumn(
        "full_at", F.col("source_size") / F.col("weight"))
    ordered = running_totals(ranked, [("full_at", True), ("missing", True), ("source", True)],
                             {"words": F.col("source_size"), "heavy": F.col("weight")})
    # Level if just the sources before and at this one were full; valid from the last one that is.
    before = F.col("words_cum") - F.col("source_size")
    behind = F.col("heavy_total") - F.col("heavy_cum") + F.col("weight")
    level = (share * F.col("words_total") - most * before) / behind
    ordered = materialise(ordered.withColumn("level", level), "levels")
    # The first source in this order that stays below its limit has the right level.
    first = (ordered.where(most * F.col("full_at") > F.col("level"))
             .agg(F.min(F.struct("full_at", "missing", "source", "level")).alias("x")).select("x.level").first()[0])
    limit = most * F.col("source_size").cast("double")
    target = limit if first is None else F.least(limit, F.lit(first) * F.col("weight"))
    return ordered.select("source", "source_size", target.alias("target"))


def _uniform(*cols: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))


def _fold(level: int, seed: int):
    """State (live: the fractional document or NULL, done: rounded ones) and one more document."""
    nothing = F.lit(None).cast(_ITEM)

    def step(state: Column, new: Column) -> Column:
        live = state["live"]

        def paired(a: Column, b: Column) -> Column:
            words_a, words_b = a["p"] * a["size"], b["p"] * b["size"]
            room_a, room_b = a["size"] - words_a, b["size"] - words_b
            up, down = F.least(room_a, words_b), F.least(words_a, room_b)
            rise = _uniform(F.lit(seed), F.lit(level), a["item"], b["item"]) * (up + down) < down
            moved = F.when(rise, up).otherwise(-down)
            # The side that limits the move is set to its bound, so no rounding error keeps it fractional.
            a_ends = F.when(rise, room_a <= words_b).otherwise(words_a <= room_b)
            a_p = F.when(a_ends, F.when(rise, 1.0).otherwise(0.0)).otherwise((words_a + moved) / a["size"])
            b_p = F.when(a_ends, (words_b - moved) / b["size"]).otherwise(F.when(rise, 0.0).otherwise(1.0))
            rest_p = F.when(a_ends, b_p).otherwise(a_p)
            ended = F.when(a_ends, F.struct(a["item"], a["size"], a_p.alias("p"))).otherwise(
                F.struct(b["item"], b["size"], b_p.alias("p")))
            rest = F.when(a_ends, F.struct(b["item"], b["size"], rest_p.alias("p"))).otherwise(
                F.struct(a["item"], a["size"], rest_p.alias("p")))
            settled = (rest_p < 1e-12) | (rest_p > 1 - 1e-12)
            rounded = F.struct(rest["item"].alias("item"), rest["size"].alias("size"), F.round(rest_p).alias("p"))
            return F.struct(
                F.when(settled, nothing).otherwise(rest.cast(_ITEM)).alias("live"),
                F.concat(state["done"], F.array(ended.cast(_ITEM)),
                         F.when(settled, F.array(rounded.cast(_ITEM))).otherwise(
                             F.array().cast(f"array<{_ITEM}>"))).alias("done"))

        return F.when(live.isNull(), F.struct(new.cast(_ITEM).alias("live"), state["done"].alias("done"))).otherwise(
            paired(live, new))
    return step


def copies(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", size: Column | None = None,
           weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 1) -> DataFrame:
    """How often the mix takes each document: ``id``, ``source``, ``size``, ``source_size``, ``target``, ``rows``
    (input rows with that id, source and size) and ``taken`` (copies of them in all).

    Equal rows are interchangeable and rounded as one: of m rows wanted p times, floor(m * p) are taken and one
    enters the rounding with the rest. A document of size 0 has no words to take and 0 copies. Null ids and
    sources are values like others. The draws hash ids, sizes and ``seed``: reruns agree, whatever the
    partitioning. Other columns are ignored. An empty table gives no rows.
    """
    size = word_count(F.col("text")) if size is None else size
    rows = materialise(
        docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"))
        .groupBy("id", "source", "size").agg(F.count("*").alias("rows")), "sizes")
    targets = materialise(source_targets(rows.select("source", (F.col("size") * F.col("rows")).alias("size")),
                                         weights, share, most), "targets")
    counts = rows.groupBy("source").agg(F.count("*").alias("items"))
    targets = targets.join(counts, targets["source"].eqNullSafe(counts["source"])).drop(counts["source"])
    targets = materialise(targets.withColumnRenamed("source", "name"), "targets")
    biggest = targets.agg(F.max("items")).first()[0] or 0

    wanted = rows.join(targets, rows["source"].eqNullSafe(targets["name"])).drop("name")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    extra = (rate - F.floor(rate)) * F.col("rows")
    wanted = (wanted.withColumn("whole", F.floor(rate) * F.col("rows") + F.floor(extra))
              .withColumn("p", F.when(F.col("size") > 0, extra - F.floor(extra)).otherwise(F.lit(0.0)))
              .withColumn("item", F.xxhash64("id", "source", "size"))
              .withColumn("bucket", F.pmod(F.xxhash64("item", F.lit(seed)), F.ceil(F.col("items") / FAN_IN))))
    wanted = materialise(wanted, "wanted")

    decided = []
    live = wanted.where("p > 0").select("source", "bucket", "item", "size", "p")
    buckets, level = max(1, -(-biggest // FAN_IN)), 0
    while True:
        grouped = live.groupBy("source", "bucket").agg(
            F.array_sort(F.collect_list(F.struct((-F.col("size")).alias("first"), "item", "size", "p"))).alias("all"))
        # Large documents meet first, so what stays fractional at the end is small.
        each = F.transform("all", lambda x: F.struct(x["item"], x["size"], x["p"]))
        start = F.struct(F.lit(None).cast(_ITEM).alias("live"), F.array().cast(f"array<{_ITEM}>").alias("done"))
        folded = materialise(grouped.select("source", "bucket", F.aggregate(each, start, _fold(level, seed)).alias("end")),
                             "folded")
        decided.append(folded.select("source", F.explode("end.done").alias("x")).select("x.item", "x.p"))
        live = folded.where("end.live IS NOT NULL").select(
            "source", F.floor(F.col("bucket") / FAN_IN).alias("bucket"), "end.live.*")
        if buckets == 1:
            last = (_uniform(F.lit(seed), F.lit(-1), F.col("item")) < F.col("p")).cast("double")
            decided.append(live.select("item", last.alias("p")))
            break
        buckets, level = -(-buckets // FAN_IN), level + 1
    picked = functools.reduce(DataFrame.unionByName, decided).where("p = 1").select("item", F.lit(1).alias("more"))
    out = wanted.join(picked, "item", "left")
    taken = F.when(F.col("size") > 0, F.col("whole") + F.coalesce("more", F.lit(0))).otherwise(F.lit(0))
    return out.select("id", "source", "size", "source_size", "target", "rows", taken.cast("long").alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", size: Column | None = None,
        weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 1) -> DataFrame:
    """The documents of the mix with all their columns, a document taken twice as two rows. See ``copies``.

    Of repeated rows (same id, source and size) the first in text order get the copies above the common number.
    Names that begin with ``__pitf`` are reserved.
    """
    names = docs.columns
    size = word_count(F.col("text")) if size is None else size
    plan = materialise(copies(docs, id_col, source_col, size, weights, share, most, seed)
                       .select(F.col("id").alias("__pitf_id"), F.col("source").alias("__pitf_source"), F.col("size").alias("__pitf_size"),
                               F.col("rows").alias("__pitf_rows"), F.col("taken").alias("__pitf_taken")), "plan")
    sized = docs.withColumn("__pitf_words", size)
    joined = sized.join(plan, sized[id_col].eqNullSafe(plan["__pitf_id"]) & sized[source_col].eqNullSafe(plan["__pitf_source"])
                        & (sized["__pitf_words"] == plan["__pitf_size"]))
    single = joined.where("__pitf_rows = 1").withColumn("__pitf_copies", F.col("__pitf_taken"))
    order = Window.partitionBy("__pitf_id", "__pitf_source", "__pitf_size").orderBy(F.xxhash64(*[docs[c] for c in names]))
    several = joined.where("__pitf_rows > 1").withColumn("__pitf_nth", F.row_number().over(order)).withColumn(
        "__pitf_copies", F.floor(F.col("__pitf_taken") / F.col("__pitf_rows")) + (F.col("__pitf_nth") <= F.col("__pitf_taken") % F.col("__pitf_rows")).cast("long"))
    both = single.select(*names, "__pitf_copies").unionByName(several.select(*names, "__pitf_copies")).where("__pitf_copies > 0")
    return both.withColumn("__pitf_copy", F.explode(F.sequence(F.lit(1), F.col("__pitf_copies").cast("int")))).select(*names)
