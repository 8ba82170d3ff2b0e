"""Byte-level BPE with a sentencepiece model written from a rank file.

A rank file gives byte strings and their ranks; a text is cut into pre-tokens by a pattern, and in each of them the
neighbouring pieces whose union has the lowest rank are joined until none has one. sentencepiece's BPE joins by the
highest score, leftmost first, and works on characters: so every byte becomes one character of its own, each entry one piece
with its negative rank as score, and the model's normalisation is the identity. The model is serialised here, field
by field, from the vocabulary alone; nothing is trained. Decoding maps ids back to the bytes of their entries.
"""
from __future__ import annotations

import base64
import itertools
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitf.llm.remembered import Remembered, flattened, spans
from pitf.llm.textcore import slices

#: Byte b stands as the character of code point FIRST_CHARACTER + b: none of them is white space or has another meaning.
FIRST_CHARACTER = 0x100
#: Stretches that no match of the pattern crosses: a run other than white space with one space before it, and white space that
#: no such run takes. Separators are white space to ``re`` but not to the tiktoken library.
STRETCH = r" ?[\S\x1C-\x1F]+|[^\S\x1C-\x1F]+(?![\S\x1C-\x1F])|[^\S\x1C-\x1F]+"
#: A letter, a number and another character that are in no alternative of a pattern by name.
STAND_INS = {"L": "é", "N": "1", "other": "§"}
#: Bytes of text encoded at once; one longer document is encoded alone.
SLICE = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and their ranks of a rank file: lines of base64, space, rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(entry): int(rank) for entry, rank in map(bytes.split, filter(None, map(bytes.strip, lines)))}


def as_characters(data: bytes) -> str:
    """One character for each byte."""
    return (np.frombuffer(data, np.uint8).astype("<u2") + np.uint16(FIRST_CHARACTER)).tobytes().decode("utf-16-le")


# Wire format of protocol buffers, and the numbers of the fields of a sentencepiece model: fixed values.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_PIECE, _SCORE, _TYPE = 1, 2, 3
_NORMAL, _UNKNOWN = 1, 2
_MODEL_TYPE, _VOCAB_SIZE, _UNK_ID, _BOS_ID, _EOS_ID, _PAD_ID = 3, 4, 40, 41, 42, 43
_BPE = 2
_NAME, _DUMMY_PREFIX, _EXTRA_SPACE, _ESCAPE_SPACE = 1, 3, 4, 5


def _varint(value: int) -> bytes:
    value &= (1 << 64) - 1
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    out.append(value)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _block(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def _float(field: int, value: float) -> bytes:
    return _varint(field << 3 | 5) + struct.pack("<f", value)


def model(entries: list[bytes]) -> bytes:
    """A serialised sentencepiece BPE model: ``entries`` in the order of their ranks, and after them the unknown piece.

    Scores are single-precision, exact up to 2^24 entries. Every single byte must be an entry.
    """
    if len(entries) >= 1 << 24 or not {bytes([b]) for b in range(256)} <= set(entries):
        raise ValueError("the entries must hold every single byte, and fewer than 2^24")
    out = [_block(_PIECES, _block(_PIECE, as_characters(x).encode()) + _float(_SCORE, -float(i)) + _number(_TYPE, _NORMAL))
           for i, x in enumerate(entries)]
    out.append(_block(_PIECES, _block(_PIECE, b"<unk>") + _float(_SCORE, 0.0) + _number(_TYPE, _UNKNOWN)))
    out.append(_block(_TRAINER, b"".join((
        _number(_MODEL_TYPE, _BPE), _number(_VOCAB_SIZE, len(entries) + 1), _number(_UNK_ID, len(entries)),
        *(_number(x, -1) for x in (_BOS_ID, _EOS_ID, _PAD_ID))))))
    out.append(_block(_NORMALIZER, _block(_NAME, b"identity")
                      + b"".join(_number(x, 0) for x in (_DUMMY_PREFIX, _EXTRA_SPACE, _ESCAPE_SPACE))))
    return b"".join(out)


@lru_cache(maxsize=1)
def disputed() -> dict[int, str]:
    """A stand-in for each code point that the regex package takes for a letter or number and the tiktoken library does not, or
    the other way round: their Unicode versions differ. Both are asked about all code points."""
    import regex
    import tiktoken

    everything = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    single = {bytes([b]): b for b in range(256)}

    def matched(cls: str) -> tuple[set[str], set[str]]:
        asked = tiktoken.Encoding("class", pat_str=cls, mergeable_ranks=single, special_tokens={})
        return set(bytes(asked.encode_ordinary(everything)).decode()), set(regex.findall(cls, everything))

    (letters, own_letters), (numbers, own_numbers) = matched(r"\p{L}"), matched(r"\p{N}")
    odd = (letters ^ own_letters) | (numbers ^ own_numbers)
    return {ord(c): STAND_INS["L" if c in letters else "N" if c in numbers else "other"] for c in odd}


def _class(code_points: list[int]) -> re.Pattern | None:
    """A pattern that finds any of them."""
    if not code_points:
        return None
    points = np.array(sorted(code_points))
    cuts = np.flatnonzero(np.diff(points) > 1) + 1
    return re.compile("[" + "".join(f"{chr(x[0])}-{chr(x[-1])}" for x in np.split(points, cuts)) + "]")


class ByteBpe:
    """Ids of texts by ranks and a pattern, as the tiktoken library gives them without special tokens.

    The pattern's matches must not cross the borders of STRETCH; what no match covers is left out.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, stand_ins: dict[int, str]):
        import regex
        import sentencepiece

        entries = sorted(ranks, key=ranks.__getitem__)
        self.ids = np.array([ranks[x] for x in entries], np.uint32)
        self.pattern, self.stretches = regex.compile(pattern), re.compile(STRETCH)
        self.stand_ins, self.odd = stand_ins, _class(list(stand_ins))
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model(entries))
        # A pre-token that is an entry is that entry, also where joining by rank does not lead to it.
        self.whole: dict[bytes, list[int]] = {}
        self.whole = {x: [i] for i, (x, got) in enumerate(zip(entries, self.joined(entries), strict=True)) if got != [i]}
        self.remembered: Remembered[str] = Remembered(self._stretch_ids)

    def joined(self, pre_tokens: list[bytes]) -> list[list[int]]:
        """Pieces of each pre-token."""
        ends = list(itertools.accumulate(map(len, pre_tokens), initial=0))
        characters = as_characters(b"".join(pre_tokens))
        found = self.processor.encode([characters[a:b] for a, b in itertools.pairwise(ends)], out_type=int, num_threads=1)
        return [self.whole.get(x, got) for x, got in zip(pre_tokens, found, strict=True)] if self.whole else found

    def _split(self, stretch: str) -> list[str]:
        if self.odd and self.odd.search(stretch):
            return [stretch[m.start():m.end()] for m in self.pattern.finditer(stretch.translate(self.stand_ins))]
        return self.pattern.findall(stretch)

    def _stretch_ids(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        text = "\n".join(stretches)
        if self.odd and self.odd.search(text) or any(map(str.isspace, stretches)):
            split = [self._split(x) for x in stretches]
            pre_tokens = list(itertools.chain.from_iterable(split))
            owner = np.repeat(np.arange(len(split)), np.fromiter(map(len, split), np.int64, len(split)))
        else:  # no stretch holds a line end, so each one found is a border
            found = self.pattern.findall(text)
            border = np.fromiter(map("\n".__eq__, found), bool, len(found))
            pre_tokens = [x for x in found if x != "\n"]
            owner = np.cumsum(border)[~border]
        place = {x: i for i, x in enumerate(dict.fromkeys(pre_tokens))}
        flat, lengths = flattened(self.joined([x.encode() for x in place]))
        starts = np.cumsum(lengths) - lengths
        at = np.fromiter(map(place.__getitem__, pre_tokens), np.int64, len(pre_tokens))
        taken = np.bincount(owner, lengths[at], len(stretches)).astype(np.int64)
        return flat[spans(starts[at], lengths[at])], taken

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each has."""
        flat, counts = self.remembered.encode([self.stretches.findall(x) for x in texts])
        return self.ids[flat], counts


def _binary(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Bytes cut into values of the given lengths."""
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [
        None, pa.py_buffer(offsets), pa.py_buffer(data)]).cast(pa.binary())


def _encoder(vocabulary, pattern: str, stand_ins: dict[int, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = ByteBpe(vocabulary.value, pattern, stand_ins)
        for part in slices(batches, "text", SLICE):
            ids, counts = coder.encode([x or "" for x in part.column(1).to_pylist()])
            raw = np.frombuffer(ids.astype("<u4").tobytes(), np.uint8)
            yield pa.RecordBatch.from_arrays([part.column(0), _binary(raw, 4 * counts)], ["id", "ids"])
    return run


def _decoder(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = {i: x for x, i in vocabulary.value.items()}
        lengths = np.zeros(max(entries) + 1, np.int64)
        lengths[list(entries)] = [len(x) for x in entries.values()]
        flat = np.frombuffer(b"".join(entries.get(i, b"") for i in range(len(lengths))), np.uint8)
        starts = np.cumsum(lengths) - lengths
        for part in slices(batches, "ids", SLICE):
            column = part.column(part.schema.get_field_index("ids")).cast(pa.large_binary()).fill_null(b"")
            offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
            held = column.buffers()[2]
            ids = np.frombuffer(held, np.uint8)[offsets[0]:offsets[-1]].view("<u4") if offsets[-1] > offsets[0] else np.zeros(0, "<u4")
            taken = lengths[ids]
            ends = np.concatenate(([0], np.cumsum(taken)))[(offsets - offsets[0]) // 4]
            data = _binary(flat[spans(starts[ids], taken)], np.diff(ends))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), data], ["id", "ids", "decoded"])
    return run


def _vocabulary(frame: DataFrame, path: str):
    """The rank file, broadcast: its size is the vocabulary's, whatever the data."""
    return frame.sparkSession.sparkContext.broadcast(read_ranks(path))


def encode(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``ids`` (unsigned little-endian 32-bit, end to end) of every row; no special tokens.

    ``ranks`` is the path of a rank file. A null or empty text has no ids; texts are encoded whole. Null and repeated ids and
    rows are rows like any others; other columns, whatever their names, are ignored; an empty table gives no rows.
    """
    stand_ins = disputed()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(_encoder(_vocabulary(docs, ranks), pattern, stand_ins), f"id {kind}, ids binary").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ranks: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col``, ``ids`` and ``decoded``, the bytes of each row's ids end to end; null ids are none.

    Bytes need not be UTF-8, since a sequence may end inside a character. Other columns are ignored.
    """
    ids = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    kind = ids.schema["id"].dataType.simpleString()
    return ids.mapInArrow(_decoder(_vocabulary(encoded, ranks)), f"id {kind}, ids binary, decoded binary").withColumnRenamed("id", id_col)
