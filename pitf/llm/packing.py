"""Sum-of-squares online packing of tokenised documents into windows.

Every document is a list of token ids ended by a separator. Whole windows are cut off it first; what is
left is placed, as the document arrives, into the open windows' fill level that makes the sum of
the squared counts of partly filled windows smallest. The counts stand in an array by level. Each
Spark partition packs its own stream, so work and memory are bounded by the window, not by the data.
What is open when a stream ends is drained: its pieces are laid end to end over windows (cut where a window
is full) and the last rest is cut at powers of two, where a sequence needs no padding.
"""
from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitf.llm.remembered import Remembered, flattened
from pitf.llm.textcore import slices, small_batches

#: Bytes of text tokenised at once; one longer document is handled alone.
SLICE = 1 << 20
#: Code points asked about as letters, and punctuation that ends a word.
LETTERS = range(0x61, 0x250)
ENDS = ".,;:!?%#*$|)"
ENDS_BYTES = frozenset(ENDS.encode())
#: Sequences that one partition may number.
NUMBERS = 1 << 40


class WordTokenizer(Remembered[bytes]):
    """Ids of a text by a tokenizer that never joins what white space separates and ignores the case of A-Z: each word is
    looked up once, and a new one that is a word and punctuation after its last letter is put together from both."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Letters that pass all steps before the merges unchanged and in one piece, and as what they reach the merges: a word
        # of such letters needs the merges only, and other characters end it.
        self.reaching: dict[int, str] = {}
        for letter in filter(str.isalpha, map(chr, LETTERS)):
            pieces = self._pieces(letter)
            if pieces is not None and len(pieces) == 1:
                self.reaching[ord(letter)] = pieces[0]
        letters = "".join(map(chr, self.reaching))
        if self._pieces(letters) != [letters.translate(self.reaching)]:
            self.reaching, letters = {}, ""
        self.word = re.compile(f"[{letters}]+" if letters else r"\Z.").fullmatch
        ends = "".join(x for x in ENDS if letters and (self._pieces(letters[0] + x) or [""])[0] == self.reaching[ord(letters[0])])
        self.ended = re.compile(f"(.*[{letters}])([{re.escape(ends)}]+)" if ends else r"\Z.", re.S).fullmatch
        super().__init__(self._tokenised)

    def _pieces(self, text: str) -> list[str] | None:
        """What of a text reaches the merges; None if it is changed before."""
        steps = self.tokenizer
        if steps.normalizer and steps.normalizer.normalize_str(text) != text:
            return None
        return [x for x, _ in steps.pre_tokenizer.pre_tokenize_str(text)] if steps.pre_tokenizer else [text]

    def _tokenised(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        texts = [w.decode() for w in words]
        plain = [self.word(x) is not None for x in texts]
        rest = iter(self.tokenizer.encode_batch_fast([x for x, is_plain in zip(texts, plain, strict=True) if not is_plain], add_special_tokens=False))
        merged = self.tokenizer.model.tokenize
        return flattened([[t.id for t in merged(x.translate(self.reaching))] if is_plain else next(rest).ids
                          for x, is_plain in zip(texts, plain, strict=True)])

    def learn(self, words: Iterable[bytes]) -> None:
        ended = {w: tuple(x.encode() for x in m.groups()) for w in words if (w[-1] in ENDS_BYTES) and (m := self.ended(w.decode()))}
        super().learn(chain(chain.from_iterable(ended.values()), (w for w in words if w not in ended)))
        self.store(list(ended), *self.joined(list(ended.values())))

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        # Of bytes: only A-Z changes and only ASCII white space separates.
        raw = [text.encode() for text in texts]
        flat, counts = self.encode([(x if b"<|" in x else x.lower()).split() for x in raw])
        return np.split(flat, np.cumsum(counts)[:-1])


class SumOfSquares:
    """Open windows by fill level; ``add`` returns the windows that a piece completes."""

    def __init__(self, size: int):
        self.size = size
        self.counts = np.zeros(size + 1, np.int64)
        self.open: list[list[list]] = [[] for _ in range(size + 1)]

    def level_for(self, length: int) -> int:
        """Moving a window from level h to h + length changes the sum by 2 (n[h + length] - n[h] + 1), by
        1 - 2 n[h] if it is then full and by 2 n[length] + 1 for a new window (h = 0)."""
        counts, size = self.counts, self.size
        change = 2 * (counts[length:size + 1] - counts[:size + 1 - length] + 1)
        change[-1] = 1 - 2 * counts[size - length]
        change[0] = 2 * counts[length] + 1
        change[1:][counts[1:size + 1 - length] == 0] = np.iinfo(np.int64).max
        return size - length - int(change[::-1].argmin())  # of equals the fullest

    def add(self, piece: tuple) -> list[tuple] | None:
        length = len(piece[2])
        level = self.level_for(length)
        window = self.open[level].pop() if level else []
        self.counts[level] -= level > 0
        window.append(piece)
        if level + length == self.size:
            return window
        self.counts[level + length] += 1
        self.open[level + length].append(window)
        return None

    def drain(self) -> Iterator[list[tuple]]:
        """Close everything: power-of-two levels as they are, the rest end to end."""
        rest: list[tuple] = []
        for level in range(self.size - 1, 0, -1):
            for window in self.open[level]:
                if level & (level - 1) == 0:
                    yield window
                else:
                    rest += window
        left = sum(len(x[2]) for x in rest)
        window, room = [], 0
        for doc, start, ids, total in rest:
            while len(ids):
                if not room:
                    if window:
                        yield window
                    window = []
                    room = self.size if left >= self.size else 1 << (left.bit_length() - 1)
                window.append((doc, start, ids[:room], total))
                start, left = start + len(ids[:room]), left - len(ids[:room])
                room, ids = room - len(ids[:room]), ids[room:]
        if window:
            yield window


def _packer(path: str, size: int, end_id: int, memory):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() * NUMBERS
        # A worker's copy of the broadcast dict outlives its tasks, so they share the words met before.
        words = memory.value.setdefault(path, None) or WordTokenizer(path)
        memory.value[path] = words
        levels = SumOfSquares(size)
        rows: list[tuple] = []

        def flush():
            nonlocal rows
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            rows = []
            kinds = (kind, pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                              ["id", "start", "ids", "doc_tokens", "sequence_id", "offset"])

        def close(window):
            nonlocal number
            offset = 0
            for doc, start, ids, total in window:
                rows.append((doc, start, ids.tobytes(), total, number, offset))
                offset += len(ids)
            number += 1

        kind = None
        for part in slices(batches, "text", SLICE):
            kind = part.schema.field(0).type
            texts = [x or "" for x in part.column(1).to_pylist()]
            for doc, ids in zip(part.column(0).to_pylist(), words.ids(texts), strict=True):
                ids = np.append(ids, np.uint32(end_id))
                whole = len(ids) - len(ids) % size
                for start in range(0, whole, size):
                    close([(doc, start, ids[start:start + size], len(ids))])
                if whole < len(ids) and (full := levels.add((doc, whole, ids[whole:], len(ids)))):
                    close(full)
            yield flush()
        if kind is not None:
            for window in levels.drain():
                close(window)
            yield flush()
    return run


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", size: int = 2048,
         end_id: int = 1) -> DataFrame:
    """One row per piece: ``id_col``, ``start`` (tokens of the document before it), ``ids`` (its token ids, unsigned
    little-endian 32-bit), ``doc_tokens``, ``sequence_id`` and ``offset`` in that sequence.

    ``tokenizer`` is the path of a tokenizers file; it must not join across white space. Each document gets
    ``end_id`` at its end, so a null or empty text is one token. Sequences hold at most ``size`` tokens
    (a power of two) and have no gaps; padding is left to the reader. Null ids, repeated rows and ids are
    packed like any others; other columns are ignored; an empty table gives no rows.
    """
    if size & (size - 1):
        raise ValueError("size must be a power of two")
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(
        _packer(tokenizer, size, end_id, docs.sparkSession.sparkContext.broadcast({})),
        f"id {kind}, start long, ids binary, doc_tokens long, sequence_id long, offset long",
    ).withColumnRenamed("id", id_col)
