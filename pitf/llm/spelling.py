"""Spelling variants by Bloom-guided neighbourhoods.

Two words are near if one inserted, deleted or replaced code point makes the one the other. The vocabulary is put into blocked
Bloom filters, one set of shards for each word length, which are broadcast in rounds of bounded size. Every
word's edits are hashed without being written out and probed against the filters of their length; only what a
filter holds becomes a string, is shuffled, and joined with the vocabulary itself, which removes false positives. A pair is
found from one side: by a deletion from the longer word, or by replacing a letter by a later one.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitf.llm.textcore import MULTIPLIER, mix, powers, slices
from pitf.session import materialise

#: Words of a filter shard, bits a word takes in it, bits set for a word, 64-bit words of a block.
SHARD_WORDS, BITS, SET, BLOCK = 1 << 16, 16, 6, 8
#: Bytes of filters that are broadcast at once; a larger vocabulary takes more rounds.
BROADCAST_BYTES = 32 << 20
#: Counted words, or bytes of read text, after which a task gives away its counts.
HELD_WORDS, HELD_BYTES = 300_000, 64 << 20
#: Letters of words whose edits are hashed at once; found edits and their letters in one batch.
LETTERS, FOUND_ROWS, FOUND_LETTERS = 1 << 16, 10_000, 1 << 20
#: Inverse of the hashes' multiplier modulo 2^64.
INVERSE = pow(MULTIPLIER, -1, 1 << 64)


def _counter(least: int, every: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile(f"[a-zÀ-ÿ]{{{least},}}").findall
        counts: Counter[str] = Counter()
        read = 0

        def given():
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
                                              ["word", "n"])

        for part in slices(batches, "text"):
            for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                lower = (text or "").encode().lower()  # of bytes: only A-Z changes
                words = find(lower.decode())
                counts.update(words)
                read += len(lower)
                if every:
                    start = crc32(f"{key or ''}:".encode())
                    for word, place in [(w, h % len(w)) for w in words if not (h := crc32(w.encode(), start)) % every]:
                        counts[word] -= 1
                        if len(word) > least:
                            counts[word[:place] + word[place + 1:]] += 1
            if len(counts) > HELD_WORDS or read > HELD_BYTES:
                yield given()
                counts, read = Counter(), 0
        yield given()
    return run


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 7, least_count: int = 2,
                every: int | None = None) -> DataFrame:
    """``word`` and ``n`` of all words with at least ``least_length`` code points and ``least_count`` occurrences.

    Words are the maximal runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z in lower case. With ``every``, where it divides h, the
    crc32 of "<id>:<word>", an occurrence counts for the word without its code point h % length. A null
    text has no words, a null id is an empty string there; repeated rows and ids count each time; other columns are ignored.
    """
    texts = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return (texts.mapInArrow(_counter(least_length, every), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count))


def _codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row for each."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), -1).astype(np.uint64)


def _hashes(codes: np.ndarray) -> np.ndarray:
    return ((codes + np.uint64(1)) * powers(codes.shape[1])[:codes.shape[1]]).sum(axis=1, dtype=np.uint64)


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """Places of the words of each length, in bundles of a bounded number of letters."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths).tolist():
        places = np.flatnonzero(lengths == length)
        step = max(1, LETTERS // max(length, 1))
        for start in range(0, len(places), step):
            yield length, places[start:start + step]


class Shards:
    """Blocked Bloom filters of the words of one length: a hash goes to a shard, a block of it and bits of the block."""

    def __init__(self, parts: int, bits: dict[int, np.ndarray]):
        self.parts, self.bits = parts, bits

    @staticmethod
    def part(spread: np.ndarray, parts: int) -> np.ndarray:
        return (spread >> np.uint64(40)) % np.uint64(parts)

    @staticmethod
    def bit(spread: np.ndarray, nth: int) -> tuple[np.ndarray, np.ndarray]:
        """Word of a block and mask of the n-th bit of each hash."""
        place = mix(spread + np.uint64(nth + 1)) & np.uint64(64 * BLOCK - 1)
        return (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63))

    @staticmethod
    def build(spread: np.ndarray) -> np.ndarray:
        blocks = max(1, -(-len(spread) * BITS // (64 * BLOCK)))
        bits = np.zeros(blocks * BLOCK, np.uint64)
        block = (spread & np.uint64(0xFFFFFFFF)).astype(np.int64) % blocks * BLOCK
        for nth in range(SET):
            word, mask = Shards.bit(spread, nth)
            np.bitwise_or.at(bits, block + word, mask)
        return bits

    def held(self, hashes: np.ndarray) -> np.ndarray:
        """Places of the hashes that the shards at hand may hold."""
        spread = mix(hashes)
        part = self.part(spread, self.parts)
        found = []
        for at, bits in self.bits.items():
            left = np.flatnonzero(part == np.uint64(at)) if self.parts > 1 else np.arange(len(hashes))
            own = spread[left]
            block = (own & np.uint64(0xFFFFFFFF)).astype(np.int64) % (len(bits) // BLOCK) * BLOCK
            for nth in range(SET):  # most are gone after the first bits
                word, mask = self.bit(own, nth)
                stay = np.flatnonzero(bits[block + word] & mask)
                left, own, block = left[stay], own[stay], block[stay]
            found.append(left)
        return np.concatenate(found)


def _spread(parts_of: dict[int, int]):
    """Length, shard and spread hash of every word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            for length, places in _by_length(words):
                spread = mix(_hashes(_codes([words[i] for i in places.tolist()])))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(places), length), pa.int32()),
                                                  pa.array(Shards.part(spread, parts_of[length]).astype(np.int32)),
                                                  pa.array(spread.view(np.int64))], ["length", "part", "hash"])
    return run


def _filter(group: pd.DataFrame) -> pd.DataFrame:
    bits = Shards.build(group["hash"].to_numpy().view(np.uint64))
    return pd.DataFrame({"length": group["length"].iloc[:1], "part": group["part"].iloc[:1], "bits": [bits.tobytes()]})


def edits(words: list[str], shards: dict[int, Shards], letters: str) -> Iterator[tuple[int, str]]:
    """Place of the word and the edit, for every edit that the shards may hold."""
    later = np.frombuffer(letters.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    for length, places in _by_length(words):
        if not length or not (length in shards or length - 1 in shards):
            continue
        codes = _codes([words[i] for i in places.tolist()])
        weight = powers(length)[:length]
        before = np.zeros((len(codes), length + 1), np.uint64)
        np.cumsum((codes + np.uint64(1)) * weight, axis=1, out=before[:, 1:])
        whole = before[:, -1:]
        if length - 1 in shards:
            gone = (before[:, :-1] + (whole - before[:, 1:]) * np.uint64(INVERSE)).ravel()
            new = np.ones(codes.shape, bool)  # equal letters in a row leave the same word
            new[:, 1:] = codes[:, 1:] != codes[:, :-1]
            at = np.flatnonzero(new.ravel())
            for place in at[shards[length - 1].held(gone[at])].tolist():
                row, i = divmod(place, length)
                word = words[places[row]]
                yield int(places[row]), word[:i] + word[i + 1:]
        if length in shards:
            flat = codes.ravel()
            weights = np.tile(weight, len(codes))
            wholes = np.repeat(whole.ravel(), length)
            for letter, code in zip(letters, later, strict=True):
                at = np.flatnonzero(flat < code)
                hashes = wholes[at] + (code - flat[at]) * weights[at]
                for place in at[shards[length].held(hashes)].tolist():
                    row, i = divmod(place, length)
                    word = words[places[row]]
                    yield int(places[row]), word[:i] + letter + word[i + 1:]


def _prober(filters, letters: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = {length: Shards(parts, {k: np.frombuffer(b, np.uint64) for k, b in bits.items()})
                  for length, (parts, bits) in filters.value.items()}
        kinds = (pa.string(), pa.int64(), pa.string())
        for batch in batches:
            words, counts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows: list[tuple] = []
            held = 0
            for place, edit in edits(words, shards, letters):
                rows.append((words[place], counts[place], edit))
                held += 2 * len(edit)
                if len(rows) == FOUND_ROWS or held > FOUND_LETTERS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                                     ["word", "n", "edit"])
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                                 ["word", "n", "edit"])
    return run


def near_pairs(words: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``a``, ``a_n``, ``b``, ``b_n`` of every two near words of a table of distinct ``word`` and ``n``, each pair once.

    Words without a code point take no part. What comes to the driver are one row for each word length, the distinct code points, and
    the filters of a round, at most ``broadcast_bytes`` (or one shard's).
    """
    spark = words.sparkSession
    words = words.where("word <> ''").select("word", F.col("n").cast("long").alias("n"))
    sizes = {r[0]: r[1] for r in words.groupBy(F.char_length("word")).count().collect()}
    letters = "".join(sorted(r[0] for r in words.select(F.explode(F.split("word", "")).alias("c")).where("c <> ''").distinct().collect()))
    parts_of = {length: -(-n // SHARD_WORDS) for length, n in sizes.items()}
    hashed = words.select("word").mapInArrow(_spread(parts_of), "length int, part int, hash long")
    filters = materialise(hashed.groupBy("length", "part").applyInPandas(_filter, "length int, part int, bits binary"), "filters")
    rounds: list[list] = [[]]
    room = broadcast_bytes
    for length, part, size in sorted(filters.select("length", "part", F.length("bits")).toLocalIterator()):
        if size > room and rounds[-1]:
            rounds.append([])
            room = broadcast_bytes
        rounds[-1].append((length, part))
        room -= size
    found = None
    for members in rounds:
        inside = F.struct("length", "part").between(F.struct(F.lit(members[0][0]), F.lit(members[0][1])),
                                                    F.struct(F.lit(members[-1][0]), F.lit(members[-1][1]))) if members else F.lit(False)
        held: dict[int, tuple[int, dict]] = {}
        for length, part, bits in filters.where(inside).toLocalIterator():
            held.setdefault(length, (parts_of[length], {}))[1][part] = bytes(bits)
        probed = words.mapInArrow(_prober(spark.sparkContext.broadcast(held), letters), "word string, n long, edit string")
        found = probed if found is None else found.unionByName(probed)
    exact = words.select(F.col("word").alias("edit"), F.col("n").alias("edit_n"))
    return found.join(exact, "edit").select(F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("edit").alias("b"),
                                            F.col("edit_n").alias("b_n"))


def variants(words: DataFrame, factor: int = 10, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of every row of a table of distinct ``word`` and ``n``.

    The form is the near word of the largest n, ties to the smallest in code-point order, if that n is at least ``factor`` (over 1)
    times the word's; else null. The root is where following forms ends, the word itself without one. An
    empty table gives no rows.
    """
    if factor <= 1:
        raise ValueError("factor must be above 1, or forms could go in a circle")
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # probing is heavy for so small a table
    words = materialise(words.select("word", F.col("n").cast("long").alias("n")).repartition(tasks, "word"), "words")
    side = lambda w, near: F.struct(F.col(w).alias("word"), F.struct((-F.col(f"{near}_n")).alias("minus"), F.col(near).alias("near")).alias("best"))
    each = near_pairs(words, broadcast_bytes).select(F.explode(F.array(side("a", "b"), side("b", "a"))).alias("x")).select("x.*")
    best = each.groupBy("word").agg(F.count("*").alias("n_near"), F.min("best").alias("best"))
    clear = -F.col("best.minus") >= factor * F.col("n")
    formed = materialise(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(clear, F.col("best.near")).alias("form"),
        F.when(clear, -F.col("best.minus")).alias("form_n")), "forms")
    # Each step doubles the forms followed; n grows by the factor along them, so few steps are left even of long chains.
    roots = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        further = materialise(roots.join(roots.select(F.col("word").alias("root"), F.col("root").alias("next")), "root"), "further")
        if further.isEmpty():
            break
        roots = materialise(roots.join(further.select("word", "next"), "word", "left")
                            .select("word", F.coalesce("next", "root").alias("root")), "roots")
    return formed.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
