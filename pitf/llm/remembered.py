"""Token ids of the words met before, in a memory bounded by bytes."""
from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable
from typing import Generic, TypeVar

import numpy as np

Word = TypeVar("Word", str, bytes)

#: Bytes that the words of a Python worker may take between two batches.
BYTES = 80 << 20
#: What a word takes beside its characters and ids: its object, its place in the dict, start, length and use.
PER_WORD = 180


class Growing:
    """An array that doubles when it is full."""

    def __init__(self, kind: type):
        self.room = np.zeros(1024, kind)
        self.size = 0

    @property
    def values(self) -> np.ndarray:
        return self.room[:self.size]

    def extend(self, new: np.ndarray) -> None:
        need = self.size + len(new)
        if need > len(self.room):
            room = np.zeros(max(need, 2 * len(self.room)), self.room.dtype)
            room[:self.size] = self.values
            self.room = room
        self.room[self.size:need] = new
        self.size = need


class Remembered(Generic[Word]):
    """Ids by word. ``look_up`` gives the ids of new words end to end and how many each has; what is remembered changes no result, only how often it is asked.

    Beyond ``limit`` bytes the words used least are forgotten, until half the limit is left. The bound is
    kept between calls: one call may add the new words of its own texts.
    """

    def __init__(self, look_up: Callable[[list[Word]], tuple[np.ndarray, np.ndarray]], limit: int = BYTES):
        self.look_up, self.limit = look_up, limit
        self._empty()

    def _empty(self) -> None:
        self.known: dict[Word, int] = {}
        self.starts, self.lengths, self.uses = Growing(np.int64), Growing(np.int32), Growing(np.int64)
        self.flat = Growing(np.uint32)
        self.size = 0

    def _add(self, names: list[Word], lengths: np.ndarray, flat: np.ndarray, uses: np.ndarray) -> None:
        self.known.update(zip(names, range(len(self.known), len(self.known) + len(names)), strict=True))
        self.starts.extend(self.flat.size + np.cumsum(lengths) - lengths)
        self.lengths.extend(lengths)
        self.uses.extend(uses)
        self.flat.extend(flat)
        self.size += sum(map(len, names)) + PER_WORD * len(names) + 4 * len(flat)

    def _forget(self) -> None:
        """Keep the words used most, up to half the limit; of equals the older."""
        names = list(self.known)
        uses, lengths, starts, flat = self.uses.values, self.lengths.values, self.starts.values, self.flat.values
        order = np.argsort(-uses, kind="stable")
        cost = np.fromiter(map(len, names), np.int64, len(names)) + PER_WORD + 4 * lengths.astype(np.int64)
        kept = np.sort(order[np.cumsum(cost[order]) <= self.limit // 2])
        parts = spans(starts[kept], lengths[kept].astype(np.int64))
        kept_flat, kept_lengths, kept_uses = flat[parts], lengths[kept], uses[kept] // 2
        kept_names = [names[i] for i in kept.tolist()]
        self._empty()
        self._add(kept_names, kept_lengths, kept_flat, kept_uses)

    def learn(self, words: Iterable[Word]) -> None:
        """Look up those words that are not known yet."""
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        if new:
            self.store(new, *self.look_up(new))

    def store(self, names: list[Word], flat: np.ndarray, lengths: np.ndarray) -> None:
        self._add(names, lengths, flat, np.zeros(len(names), np.int64))

    def joined(self, texts: list[list[Word]]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words of all texts, words that are known, end to end, and how many each text has."""
        words = np.fromiter(map(len, texts), np.int64, len(texts))
        at = np.fromiter(map(self.known.__getitem__, itertools.chain.from_iterable(texts)), np.int64, int(words.sum()))
        self.uses.values[:] += np.bincount(at, minlength=self.uses.size)
        lengths = self.lengths.values[at].astype(np.int64)
        ends = np.concatenate(([0], np.cumsum(lengths)))[np.concatenate(([0], np.cumsum(words)))]
        return self.flat.values[spans(self.starts.values[at], lengths)], np.diff(ends)

    def encode(self, texts: list[list[Word]]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each given as its words, end to end, and how many each has."""
        if self.size > self.limit:
            self._forget()
        new = set(itertools.chain.from_iterable(texts)).difference(self.known)
        if new:
            self.learn(new)
        return self.joined(texts)


def flattened(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists end to end, and their lengths."""
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(lengths.sum())), lengths


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places of the values of spans, one span after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))
