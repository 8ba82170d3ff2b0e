"""Log probabilities of texts under a Katz back-off bigram model with Good-Turing discounts.

    P(w | v) = d(c(v, w)) c(v, w) / c(v)   where c(v, w) > 0, else   alpha(v) P(w)
    P(w)     = d(c(w)) c(w) / N            where c(w) > 0, else what is left, for all unknown words as one

alpha(v) = (1 - sum of the seen P(w | v)) / (1 - sum of the seen P(w)), so each distribution sums to one exactly.

Words are hashed to 64 bits. Documents are written once as blocks of token numbers with the block's word
hashes. A block asks for the counts of its words and word pairs by sending sorted, packed hashes to
partitions of the hash range; there they are summed over all blocks, and each block gets its counts back in the order it
asked, so no key travels twice. One block is named owner of each pair and adds it to its context's sums. Every
context's sums meet in one partition of the context range, where alpha is formed and applied to the tokens that backed
off. A key is at most once in a block, so no word, pair or context is a hot key.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitf.llm.textcore import MULTIPLIER, mix, slices, text_bytes, word_hashes
from pitf.session import materialise

#: Bytes of text in a block.
BLOCK_BYTES = 6 << 20
#: Counts up to which Good-Turing discounts hold; beyond, and at least, a count r keeps 1 - LEAST / r.
DISCOUNTED = 5
LEAST = 0.1
#: Hashes of the end token and of the context before the first word.
END, BEGIN = np.uint64(0x452821E638D01377), np.uint64(0xBE5466CF34E90C6C)
WORDS, PAIRS = 1, 2


def _packed(values: np.ndarray) -> bytes:
    """Bytes of equal significance side by side, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(
        np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes())


def _unpacked(data: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel() if len(raw) else np.zeros(0, kind)


def _packed_keys(keys: np.ndarray) -> bytes:
    return _packed(np.diff(keys, prepend=np.uint64(0)))


def _unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data, np.uint64), dtype=np.uint64)


def _ranges(keys: np.ndarray, parts: int) -> dict[int, slice]:
    """Slices of sorted keys by equal ranges of the hash space, those that hold keys; work grows with the keys alone."""
    part = ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    start = np.flatnonzero(np.diff(part, prepend=np.uint64(parts)) != 0)
    end = np.append(start[1:], len(keys))
    return {int(part[i]): slice(int(i), int(j)) for i, j in zip(start, end, strict=False)}


_BLOCK = "block long, ids array<{kind}>, held binary, lengths binary, tokens binary, hashes binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns id, held, text -> one row per block."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    for batch in slices(batches, "text", BLOCK_BYTES):
        hashes, doc = word_hashes(*text_bytes(batch.column(2)))
        n = len(batch)
        ends = np.searchsorted(doc, np.arange(1, n + 1)) + np.arange(n)
        stream = np.insert(hashes, np.searchsorted(doc, np.arange(1, n + 1)), END)
        known, tokens = np.unique(stream, return_inverse=True)
        held = batch.column(1).to_numpy(zero_copy_only=False).astype(np.uint8)
        ids = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), batch.column(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array([number]), ids, *(pa.array([x], pa.binary()) for x in (
                _packed(held), _packed(np.diff(ends, prepend=-1).astype(np.uint32)), _packed(tokens.astype(np.uint32)),
                _packed_keys(known)))],
            ["block", "ids", "held", "lengths", "tokens", "hashes"])
        number += 1


class _Block:
    def __init__(self, held, lengths, tokens, hashes):
        self.held = _unpacked(held, np.uint8).astype(bool)
        self.lengths = _unpacked(lengths, np.uint32).astype(np.int64)
        self.tokens = _unpacked(tokens, np.uint32).astype(np.int64)
        self.known = _unpacked_keys(hashes)
        self.doc = np.repeat(np.arange(len(self.lengths)), self.lengths)
        first = np.cumsum(self.lengths) - self.lengths
        self.context = np.concatenate(([0], self.tokens[:-1])) if len(self.tokens) else self.tokens
        self.context[first] = len(self.known)  # BEGIN
        self.contexts = np.append(self.known, BEGIN)
        self.learnt = ~self.held[self.doc]
        pairs, self.pair = np.unique(self.context * (len(self.known) + 1) + self.tokens, return_inverse=True)
        self.pair_context, self.pair_word = np.divmod(pairs, len(self.known) + 1)
        keys = mix(self.contexts[self.pair_context] * np.uint64(MULTIPLIER) + self.known[self.pair_word])
        self.order = np.argsort(keys, kind="stable")
        self.pair_keys = keys[self.order]

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.tokens[self.learnt], minlength=len(self.known)).astype(np.uint32)

    def pair_counts(self) -> np.ndarray:
        return np.bincount(self.pair[self.learnt], minlength=len(self.order)).astype(np.uint32)[self.order]


def _requests(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = _Block(row["held"], row["lengths"], row["tokens"], row["hashes"])
                out = []
                for kind, keys, counts in ((WORDS, block.known, block.word_counts()),
                                           (PAIRS, block.pair_keys, block.pair_counts())):
                    out += [(kind, p, row["block"], _packed_keys(keys[at]), _packed(counts[at]))
                            for p, at in _ranges(keys, parts).items()]
                yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=["kind", "part", "block", "keys", "counts"]).astype(
                    {"kind": "int32", "part": "int32", "block": "int64"}), preserve_index=False)
    return run


def _groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[list[dict]]:
    """Rows of equal keys from rows that come ordered by them."""
    rows: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and any(row[k] != rows[0][k] for k in keys):
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals in the order asked, whether the block owns the key, and numbers of keys by count (block NULL)."""
    for rows in _groups(batches, ("kind", "part")):
        lists = [_unpacked_keys(r["keys"]) for r in rows]
        keys, place, inverse = np.unique(np.concatenate(lists), return_index=True, return_inverse=True)
        totals = np.bincount(inverse, np.concatenate([_unpacked(r["counts"], np.uint32) for r in rows])).astype(np.uint64)
        owner = np.zeros(len(inverse), np.uint8)
        owner[place] = 1
        ends = np.cumsum([len(x) for x in lists])[:-1]
        found = np.bincount(np.minimum(totals, DISCOUNTED + 2).astype(np.int64), minlength=DISCOUNTED + 3)
        tally = [*found[1:DISCOUNTED + 2].tolist(), int((totals > 0).sum()), int(totals.sum())]
        kind, part = rows[0]["kind"], rows[0]["part"]
        out = [(kind, part, r["block"], _packed(t), _packed(o), None) for r, t, o in zip(
            rows, np.split(totals[inverse], ends), np.split(owner, ends), strict=True)] + [(kind, part, None, None, None, tally)]
        columns = list(zip(*out, strict=True))
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                         ["kind", "part", "block", "totals", "owner", "tally"])


def discounts(tally: list[int]) -> np.ndarray:
    """Factors of the counts 0 (unused) to ``DISCOUNTED`` from the numbers of keys seen 1 to ``DISCOUNTED`` + 1 times."""
    n = [0, *tally]
    out = np.array([1.0] + [1 - LEAST / r for r in range(1, DISCOUNTED + 1)])
    if n[1]:
        rest = (DISCOUNTED + 1) * n[DISCOUNTED + 1] / n[1]
        for r in range(1, DISCOUNTED + 1):
            if n[r] and rest < 1:
                d = ((r + 1) * n[r + 1] / (n[r] * r) - rest) / (1 - rest)
                if 0 < d < out[r]:
                    out[r] = d
    return out


def _discounted(counts: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """d(c) c."""
    return np.where(counts <= DISCOUNTED, factors[np.minimum(counts, DISCOUNTED).astype(np.int64)] * counts, counts - LEAST)


def _scores(parts: int, model: dict):
    schema = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("sums", pa.binary()),
                        ("needs", pa.binary()), ("docs", pa.binary()), ("row", pa.int64()), ("n_known", pa.int64()),
                        ("base", pa.float64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, ("block",)):
            stored = next(r for r in rows if r["kind"] == 0)
            block = _Block(stored["held"], stored["lengths"], stored["tokens"], stored["hashes"])

            def of(kind, name, number):
                return np.concatenate([_unpacked(r[name], number) for r in rows if r["kind"] == kind] or [np.zeros(0, number)])

            words = of(WORDS, "totals", np.uint64).astype(np.float64)
            pairs, own = np.zeros(len(block.order)), np.zeros(len(block.order), bool)
            pairs[block.order], own[block.order] = of(PAIRS, "totals", np.uint64), of(PAIRS, "owner", np.uint8)
            single = np.where(words > 0, _discounted(words, model["words"]) / max(model["n"], 1), model["unknown"])
            base = np.log10((words + .5) / (model["n"] + .5 * (model["v"] + 1)))
            before = np.append(words, model["texts"])  # how often each context was followed by anything
            mass = _discounted(pairs, model["pairs"])
            seen = pairs > 0
            backed = ~seen & (before[block.pair_context] > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                log_pair = np.where(seen, np.log10(mass / before[block.pair_context]), np.log10(single[block.pair_word]))
            n = len(block.lengths)
            yield pa.RecordBatch.from_pydict({
                "part": [None] * n, "block": [stored["block"]] * n, "keys": [None] * n, "sums": [None] * n,
                "needs": [None] * n, "docs": [None] * n, "row": np.arange(n),
                "n_known": np.bincount(block.doc, words[block.tokens] > 0, n).astype(np.int64),
                "base": np.bincount(block.doc, base[block.tokens], n),
                "score": np.bincount(block.doc, log_pair[block.pair], n)}, schema=schema)

            mine = own & seen
            used = np.zeros(len(block.contexts), bool)
            used[block.pair_context[mine]] = True
            needing = backed[block.pair]
            need, times = np.unique(block.context[needing] * n + block.doc[needing], return_counts=True)
            need_context, need_doc = np.divmod(need, max(n, 1))
            order = np.argsort(block.contexts, kind="stable")
            order = order[used[order]]
            sums = np.stack([np.bincount(block.pair_context[mine], x[mine], len(used))[order] for x in
                             (mass, single[block.pair_word])] + [before[order]], axis=1)
            keys = block.contexts[order]
            need_keys = block.contexts[need_context]
            need_order = np.argsort(need_keys, kind="stable")
            need_keys, docs = need_keys[need_order], np.stack((need_doc, times), axis=1)[need_order].astype(np.uint32)
            at, wanted = _ranges(keys, parts), _ranges(need_keys, parts)
            nothing = slice(0, 0)
            out = [(p, stored["block"], _packed_keys(keys[i]), _packed(sums[i].ravel()), _packed_keys(need_keys[j]), _packed(docs[j].ravel()))
                   for p, i, j in ((p, at.get(p, nothing), wanted.get(p, nothing)) for p in at.keys() | wanted.keys())]
            columns = list(zip(*out, strict=True)) or [[]] * 6
            empty = [None] * len(out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip([*columns, empty, empty, empty, empty], schema, strict=True)], schema=schema)
    return run


def _alphas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """log10 alpha of the contexts of a part, summed over the tokens of each document that back off from them: one row
    for each block that asked, with its documents' numbers and sums packed."""
    for rows in _groups(batches, ("part",)):
        lists = [_unpacked_keys(r["keys"]) for r in rows]
        keys, inverse = np.unique(np.concatenate(lists), return_inverse=True)
        sums = np.concatenate([_unpacked(r["sums"], np.float64) for r in rows]).reshape(-1, 3)
        mass, single = (np.bincount(inverse, sums[:, i], len(keys)) for i in (0, 1))
        before = np.zeros(len(keys))
        before[inverse] = sums[:, 2]
        alpha = np.log10((1 - mass / before) / (1 - single))
        for row in rows:
            need = _unpacked_keys(row["needs"])
            docs = _unpacked(row["docs"], np.uint32).reshape(-1, 2)
            if len(need):
                touched, at = np.unique(docs[:, 0], return_inverse=True)
                total = np.bincount(at, docs[:, 1] * alpha[np.searchsorted(keys, need)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]], pa.int64()), pa.array([row["part"]], pa.int32()),
                     pa.array([_packed(touched)], pa.binary()), pa.array([_packed(total)], pa.binary())],
                    ["block", "part", "docs", "backed"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each document of a block adds by backing off. Rows come ordered by block and part."""
    block, total = None, np.zeros(0)

    def finish() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(total), block, np.int64)), pa.array(np.arange(len(total))),
                                           pa.array(total)], ["block", "row", "backed"])

    for batch in batches:
        for row in batch.to_pylist():
            if row["block"] != block:
                if block is not None:
                    yield finish()
                block, total = row["block"], np.zeros(0)
            docs = _unpacked(row["docs"], np.uint32)
            if docs[-1] >= len(total):
                total = np.append(total, np.zeros(int(docs[-1]) + 1 - len(total)))
            total[docs] += _unpacked(row["backed"], np.float64)
    if block is not None:
        yield finish()


def log_probabilities(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id_col``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` (log10).

    Words are runs of characters other than space and \\x09-\\x0D with A-Z lowered, one end token follows. Counts
    come from all rows that are not ``held_out`` (NULL: not). ``base_score`` smooths single tokens by one half; ``score``
    is the model's. A null or empty text is its end token; repeated rows count as often as they occur and score alike; null
    ids are kept; other columns are ignored; an empty table gives no rows. With no row to learn from every token is
    unknown and has all the probability: ``score`` is 0.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held"),
                        F.col(text_col).cast("string").alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    blocks = materialise(texts.mapInArrow(_blocks, _BLOCK.format(kind=kind)), "blocks")
    parts = max(1, blocks.count())
    asked = blocks.select("block", "held", "lengths", "tokens", "hashes").mapInArrow(
        _requests(parts), "kind int, part int, block long, keys binary, counts binary")
    answers = materialise(asked.repartition(F.col("kind"), F.col("part")).sortWithinPartitions("kind", "part", "block").mapInArrow(
        _answers, "kind int, part int, block long, totals binary, owner binary, tally array<long>"), "answers")
    width = DISCOUNTED + 3
    tallies = {r["kind"]: [r[f"t{i}"] for i in range(width)] for r in answers.where("block IS NULL").groupBy("kind").agg(
        *(F.sum(F.col("tally")[i]).alias(f"t{i}") for i in range(width))).collect()}
    words, pairs = (tallies.get(k, [0] * width) for k in (WORDS, PAIRS))
    model = {"words": discounts(words[:DISCOUNTED + 1]), "pairs": discounts(pairs[:DISCOUNTED + 1]),
             "v": words[-2], "n": words[-1]}
    model["texts"] = texts.where("NOT held").count()
    model["unknown"] = 1.0
    if words[-1]:
        low = words[:DISCOUNTED]
        kept = sum(n * r * model["words"][r] for r, n in enumerate(low, 1))
        above, tokens_above = words[-2] - sum(low), words[-1] - sum(n * r for r, n in enumerate(low, 1))
        model["unknown"] = 1 - (kept + tokens_above - LEAST * above) / words[-1]

    empty = F.lit(None).cast("binary")
    stored = blocks.select("block", F.lit(0).alias("kind"), F.lit(0).alias("part"), "held", "lengths", "tokens", "hashes",
                           empty.alias("totals"), empty.alias("owner"))
    replies = answers.where("block IS NOT NULL").select(
        "block", "kind", "part", *(empty.alias(c) for c in ("held", "lengths", "tokens", "hashes")), "totals", "owner")
    scored = materialise(
        stored.unionByName(replies).repartition("block").sortWithinPartitions("block", "kind", "part").mapInArrow(
            _scores(parts, model), "part int, block long, keys binary, sums binary, needs binary, docs binary, row long, "
            "n_known long, base double, score double"), "scores")
    backed = (scored.where("part IS NOT NULL").select("part", "block", "keys", "sums", "needs", "docs")
              .repartition("part").sortWithinPartitions("part", "block")
              .mapInArrow(_alphas, "block long, part int, docs binary, backed binary"))
    summed = (backed.repartition("block").sortWithinPartitions("block", "part")
              .mapInArrow(_summed, "block long, row long, backed double"))
    own = scored.where("part IS NULL").select("block", "row", "n_known", "base", "score")
    named = blocks.mapInArrow(_rows(kind), f"block long, row long, id {kind}, held boolean, n_tokens long")
    return (named.join(own, ["block", "row"]).join(summed, ["block", "row"], "left")
            .select(F.col("id").alias(id_col), F.col("held").alias("held_out"), "n_tokens", "n_known",
                    F.lit(int(model["n"])).cast("long").alias("train_tokens"), F.col("base").alias("base_score"),
                    (F.col("score") + F.coalesce("backed", F.lit(0.0))).alias("score")))


def _rows(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1)
                ids = row.column(1).flatten()
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, row.column(0)[0].as_py(), np.int64)), pa.array(np.arange(n)), ids,
                     pa.array(_unpacked(row.column(2)[0].as_py(), np.uint8).astype(bool)),
                     pa.array(_unpacked(row.column(3)[0].as_py(), np.uint32).astype(np.int64))],
                    ["block", "row", "id", "held", "n_tokens"])
    return run
