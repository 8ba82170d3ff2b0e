"""Toxicity by compression distance with zstandard dictionaries.

Texts are cut into windows of a few words. One zstandard dictionary is trained on the windows of ordinary text, another on
extracts of toxic text. A toxic document's extract is its words with wording (words, stems, pairs) that a likelihood ratio test
finds more often in toxic than in ordinary text, however small a part of the toxic rows has it; a passage that toxic
documents share counts once. A window is compressed once with the ordinary dictionary and once with both; the bytes saved by
the toxic one are its distance. A document's savings are turned into a probability by a logistic curve calibrated on
labelled documents that no dictionary saw, with the very dictionaries it is used with.
"""
from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitf.llm.labelled import fold, logistic, sample, sigmoid
from pitf.llm.textcore import slices, small_batches

#: Words in a window.
WINDOW = 6
#: Labelled rows the model is fitted on, at most; one text in so many calibrates the curve, the rest are for the dictionaries.
SAMPLE = 10_000
CALIBRATING = 8
ORDINARY_BYTES = 110 << 10
TOXIC_BYTES = 2 << 10
#: Wording goes into the toxic dictionary if it is in so many toxic documents, its share there is so many times that of
#: ordinary documents, and the likelihood ratio statistic of the two shares is at least LEAST_RATIO_TEST (chi-squared, 1 degree).
LEAST_ROWS = 3
LEAST_RATIO = 4
LEAST_RATIO_TEST = 20.0
#: Bytes of the shortest and the longest stem.
STEM = 3, 11
_EDGES = b".,;:!?|*#$%&\"'()[]{}<>-_=/\\"


def windows(text: str, size: int = WINDOW) -> list[bytes]:
    """Lower-case windows of ``size`` words, the last one shorter; a text without words gives one empty window."""
    words = text.lower().encode().split()
    return [b" " + b" ".join(words[i:i + size]) + b" " for i in range(0, len(words), size)] or [b""]


def _trained(size: int, parts: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(size, parts, level=3).as_bytes()
    except zstandard.ZstdError:  # too little text for the trainer: the text itself is the dictionary
        return b"".join(parts)[-size:]


@dataclass
class ToxicModel:
    ordinary: bytes
    toxic: bytes
    weights: np.ndarray | None  # None: the labels held only one class
    constant: float

    def _compressor(self, content: bytes) -> zstandard.ZstdCompressor:
        plain = zstandard.ZstdCompressionParameters.from_level(
            3, write_checksum=False, write_content_size=False, write_dict_id=False)
        return zstandard.ZstdCompressor(
            dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            compression_params=plain)

    def savings(self, texts: Iterator[str]) -> Iterator[np.ndarray]:
        """Bytes that the toxic dictionary saves in each window of each text."""
        ordinary = self._compressor(self.ordinary).compress
        toxic = self._compressor(self.ordinary + b" " + self.toxic).compress
        for text in texts:
            yield np.array([len(ordinary(w)) - len(toxic(w)) for w in windows(text)])

    @staticmethod
    def features(saved: np.ndarray) -> list[float]:
        top = np.sort(saved)[::-1]
        return [1.0, float(top[0]), float(top[:3].clip(0).sum()), math.log(len(saved)),
                *(math.log1p((saved >= n).sum()) for n in (3, 5, 7, 9)), *(float((saved >= n).mean()) * 10 for n in (4, 6))]

    def scores(self, texts: Iterator[str]) -> np.ndarray:
        if self.weights is None:
            return np.array([self.constant for _ in texts])
        x = np.array([self.features(s) for s in self.savings(texts)]).reshape(-1, len(self.weights))
        return sigmoid(x @ self.weights)


def _words(text: str) -> list[bytes]:
    return [w for w in (w.strip(_EDGES) for w in text.lower().encode().split()) if w]


def _wording(text: str, met: set[int] | None = None) -> set[bytes]:
    """Words, their stems and pairs of neighbours: after a space, and before one unless it is a stem.

    With ``met``, the hashes of three words in a row of the texts before, only those words whose three up to them and whose
    three from them on are new: neither a shared passage nor what surrounds an edit in it counts again.
    """
    found = _words(text)
    new = [True] * len(found)
    if met is not None:
        edged = [b"", b"", *found, b"", b""]
        threes = [hash(x) for x in zip(edged, edged[1:], edged[2:], strict=False)]
        fresh = [x not in met for x in threes]
        new = [a and b for a, b in zip(fresh, fresh[2:], strict=False)][:len(found)]
        met.update(threes)
    out = {b" " + a + b" " + b + b" " for a, b, *fresh in zip(found, found[1:], new, new[1:], strict=False) if all(fresh)}
    for w in {w for w, fresh in zip(found, new, strict=True) if fresh}:
        out.add(b" " + w + b" ")
        out.update(b" " + w[:n] for n in range(STEM[0], min(len(w), STEM[1] + 1)))
    return out


def _surprise(toxic: int, ordinary: int, n_toxic: int, n_ordinary: int) -> float:
    """Likelihood ratio statistic of two shares against a common one."""
    def part(x: int, expected: float) -> float:
        return x * math.log(x / expected) if x else 0.0

    both = (toxic + ordinary) / (n_toxic + n_ordinary)
    return 2 * (part(toxic, n_toxic * both) + part(ordinary, n_ordinary * both)
                + part(n_toxic - toxic, n_toxic * (1 - both)) + part(n_ordinary - ordinary, n_ordinary * (1 - both)))


def _telling(toxic: Iterable[str], ordinary: Iterable[str], n_toxic: int, n_ordinary: int) -> list[bytes]:
    """The wording that sets toxic texts apart, the most telling last; a stem or pair no more telling than the longer
    form or single word it goes with is left out."""
    bad, plain = Counter(), Counter()
    met: set[int] = set()
    for text in toxic:
        bad.update(_wording(text, met))
    bad = {w: n for w, n in bad.items() if n >= LEAST_ROWS}
    for text in ordinary:
        plain.update(_wording(text) & bad.keys())
    value = {w: _surprise(n, plain[w], n_toxic, n_ordinary) for w, n in bad.items()
             if (n + .1) / n_toxic >= LEAST_RATIO * (plain[w] + .1) / n_ordinary}
    value = {w: x for w, x in value.items() if x >= LEAST_RATIO_TEST}
    beaten = {w[:-1] for w, x in value.items() if x >= value.get(w[:-1], math.inf)}
    for w, x in value.items():
        if len(words := w.split()) == 2 and any(value.get(b" " + one + b" ", 0) >= x for one in words):
            beaten.add(w)
    return sorted(value.keys() - beaten, key=lambda w: (value[w], w))


def _extract(text: str, telling: set[bytes]) -> bytes:
    """The distinct words of a text with telling wording, alone or beside their neighbour, in order of appearance."""
    found = _words(text)
    pairs = [b" " + a + b" " + b + b" " in telling for a, b in zip(found, found[1:], strict=False)]
    kept = (w for w, before, after in zip(found, [False, *pairs], [*pairs, False], strict=False)
            if before or after or b" " + w + b" " in telling or any(b" " + w[:n] in telling for n in range(STEM[0], min(len(w), STEM[1] + 1))))
    return b" ".join([b"", *dict.fromkeys(kept), b""])


def _toxic_dictionary(toxic: list[str], ordinary: list[str]) -> bytes:
    """Trained on the distinct extracts, or on the toxic windows if no wording tells the two apart for sure. Telling wording
    too rare for the trainer to take goes before it."""
    telling = _telling(toxic, ordinary, len(toxic), len(ordinary))
    wording = set(telling)
    extracts = dict.fromkeys(x for x in (_extract(text, wording) for text in toxic) if len(x) > 1)
    content = _trained(TOXIC_BYTES, list(extracts) or [w for text in toxic for w in windows(text)])
    return b"".join(w for w in telling if w not in content) + content


def fit(rows: list[tuple[str, int]]) -> ToxicModel:
    """From (text, toxic) rows. Texts are dealt by their hash, so copies stay together: a part calibrates the curve of the
    dictionaries trained on the others. With one class only in either part, every score is that of the commonest class."""
    taught, judged = [], []
    for text, label in sorted(rows):
        (taught if zlib.crc32(text.encode()) // 7 % CALIBRATING else judged).append((text, label))
    if any(len({label for _, label in part}) < 2 for part in (taught, judged)):
        return ToxicModel(b"", b"", None, float(sum(label for _, label in rows) * 2 > len(rows)))
    toxic, ordinary = ([text for text, label in taught if label == kind] for kind in (1, 0))
    model = ToxicModel(_trained(ORDINARY_BYTES, [w for text in ordinary for w in windows(text)]), _toxic_dictionary(toxic, ordinary), None, 0.0)
    x = [model.features(s) for s in model.savings(text for text, _ in judged)]
    model.weights = logistic(np.array(x), np.array([label for _, label in judged], float))
    return model


def _scorer(model: ToxicModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__pitf_text"):
            scores = model.scores(x or "" for x in batch.column(batch.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())],
                                             [*batch.schema.names[:-1], "_score"])
    return run


def score(docs: DataFrame, model: ToxicModel, text_col: str = "text", keep: tuple[str, ...] | None = None) -> DataFrame:
    """Columns ``keep`` (default: all) and ``_score``, the probability of toxic text.

    A null or empty text is one empty window. Long texts are read window by window; repeated rows score alike; an
    empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop("_score")
    texts = docs.select(*(docs.columns if keep is None else keep), F.col(text_col).alias("__pitf_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema.fields[:-1])
    return texts.mapInArrow(_scorer(model), f"{fields}, _score double")


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None, label: str = "toxic") -> ToxicModel:
    """Fit on at most ``SAMPLE`` labelled rows; see ``labelled.sample``."""
    usable = fold("doc_id", 5) != 0 if usable is None else usable
    return fit(sample(docs, labels, label, usable, SAMPLE))
