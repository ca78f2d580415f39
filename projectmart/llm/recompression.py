"""Dedup of repeated word windows by recompression.

Words are symbols. Runs of equal words are named, then rounds name pairs: a bit of each symbol says
whether it is a left or a right one, and a left symbol followed by a right one becomes a pair. Names
are hashes of what they stand for, so they are the same in all shards without a common dictionary.
What a symbol becomes depends on its neighbours alone; each symbol therefore has a context, the words
that decide about it, and wherever these words occur, they are compressed to the same symbol.

The key of a window is the highest symbol (of most words, then of the least hash) whose context lies
inside the window: equal windows have equal keys, and most keys stand for four words or more. Keys of
several documents reveal candidates; their windows are verified by names of all their words (see
``repeats``).

Defined results: a null text has no words. A null id is the smallest. Rows of equal ids do not remove
each other's words. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from projectmart.llm.arrays import WORD_BASE, SpanHash, byte_table, mix, windows, word_spans
from projectmart.llm.repeats import covered_runs, remove_repeats

WIDTH = 13
ROUNDS = 3


class Symbols:
    """A level of the compression: name, words [first, end) and context [low, high) of each symbol."""

    def __init__(self, name, text):
        n = len(name)
        self.name, self.text = name, text
        self.first, self.end = np.arange(n), np.arange(1, n + 1)
        self.low, self.high = np.arange(n), np.arange(1, n + 1)

    def _neighbours(self):
        """Contexts of the neighbours; beyond a text one word outside of it, so that no window
        holds them."""
        same = self.text[1:] == self.text[:-1]
        high = np.append(np.where(same, self.high[1:], self.high[:-1] + 1), self.high[-1:] + 1)
        low = np.append(self.low[:1] - 1, np.where(same, self.low[:-1], self.low[1:] - 1))
        return low, high

    def _take(self, at, last, name, low, high):
        self.name, self.low, self.high = name, low, high
        self.first, self.end, self.text = self.first[at], self.end[last], self.text[at]

    def name_runs(self) -> None:
        """Runs of two and more equal symbols become one. The symbols around decide where a run
        ends, and that a symbol is none: they belong to the context of every symbol."""
        if not len(self.name):
            return
        low, high = self._neighbours()
        again = (self.name[1:] == self.name[:-1]) & (self.text[1:] == self.text[:-1])
        at = np.flatnonzero(np.append(True, ~again))
        last = np.append(at[1:], len(self.name)) - 1
        size = (last - at + 1).astype(np.uint64)
        name = np.where(size > 1, mix(self.name[at] * np.uint64(3) + size), self.name[at])
        self._take(at, last, name, low[at], high[last])

    def name_pairs(self, turn: int) -> None:
        """A left symbol and the right one after it become a pair. A symbol that stays alone does
        so because of the neighbour it might have gone with."""
        if not len(self.name):
            return
        left = (mix(self.name ^ np.uint64(0x5851F42D * turn)) & np.uint64(1)).astype(bool)
        pair = left[:-1] & ~left[1:] & (self.text[1:] == self.text[:-1])
        opens, closes = np.append(pair, False), np.append(False, pair)
        around_low, around_high = self._neighbours()
        alone = ~(opens | closes)
        low = np.where(alone & ~left, around_low, self.low)
        high = np.where(alone & left, around_high, self.high)
        at = np.flatnonzero(~closes)
        last = at + opens[at]
        joint = mix(self.name[at] * np.uint64(WORD_BASE) + self.name[last] + np.uint64(turn))
        name = np.where(opens[at], joint, self.name[at])
        self._take(at, last, name, low[at], np.where(opens[at], self.high[last], high[at]))


class Words:
    """The windows of the words of a shard."""

    def __init__(self, data, offsets, width: int, hasher: SpanHash):
        self.data, self.width = data, width
        self._starts, self._ends, self._text = word_spans(data, offsets, byte_table("white"))
        self._names = hasher.spans(hasher.prefix(data), self._starts, self._ends)
        self.bounds = np.searchsorted(self._text, np.arange(len(offsets)))
        self._all = None

    def _offer(self, best, symbols: Symbols, turn: int) -> None:
        """Offer the symbols as keys to the windows that hold their contexts."""
        words = np.minimum(symbols.end - symbols.first, 15).astype(np.uint64)
        key = (words << np.uint64(60)) | (mix(symbols.name + np.uint64(turn)) >> np.uint64(4))
        room = symbols.high - symbols.low <= self.width
        low, high, key = symbols.low[room], symbols.high[room], key[room]
        for back in range(self.width):
            at = low - back
            fits = (at >= high - self.width) & (at >= 0)
            if not fits.any():
                break
            np.maximum.at(best, at[fits], key[fits])

    def stretches(self):
        n = len(self._names)
        symbols = Symbols(self._names, self._text)
        best = np.zeros(n, np.uint64)
        self._offer(best, symbols, 0)
        # Later rounds name pairs only: a context grows by a symbol on both sides with each naming of
        # runs, and must stay within a window.
        symbols.name_runs()
        for turn in range(1, ROUNDS + 1):
            symbols.name_pairs(turn)
            self._offer(best, symbols, turn)
        inside = np.zeros(n, bool)
        if n >= self.width:
            last = n - self.width + 1
            inside[:last] = self._text[:last] == self._text[self.width - 1 :]
        at = np.flatnonzero(inside)
        key, text = best[at], self._text[at]
        new = np.append(True, (key[1:] != key[:-1]) | (text[1:] != text[:-1]))[: len(key)]
        first = np.flatnonzero(new)
        return key[first], at[first], np.diff(np.append(first, len(key))), text[first]

    def window_names(self, start):
        if self._all is None:
            self._all = windows(self._names, self.width)
        return self._all[start]

    # Windows of a shard are told apart by their names alone.
    window_classes = None

    def results(self, removed):
        n = len(self._names)
        gone, runs = covered_runs(n, self.bounds, removed, self.width)
        buffer, kept = self.data.tobytes(), []
        touched = np.zeros(len(self.bounds), bool)
        touched[self._text[gone]] = True
        for t, (low, high) in enumerate(zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist())):
            at = range(low, high)
            if touched[t]:
                at = (low + np.flatnonzero(~gone[low:high])).tolist()
            elif low < high:
                whole = buffer[self._starts[low] : self._ends[high - 1]]
                kept.append(b" ".join(whole.split()))
                continue
            kept.append(b" ".join(buffer[self._starts[i] : self._ends[i]] for i in at))
        return [pa.array(np.diff(self.bounds), pa.int64()), runs, pa.array(kept, pa.binary())]


class WordFinder:
    def __init__(self, width: int = WIDTH):
        self.width, self._hasher = width, None

    def parse(self, data, offsets) -> Words:
        self._hasher = self._hasher or SpanHash()
        return Words(data, offsets, self.width, self._hasher)


def dedup_windows(docs: DataFrame, width: int = WIDTH, folder: str | None = None) -> DataFrame:
    """(doc_id, n_units, removed, kept): words, removed runs of words, kept words joined by spaces."""
    return remove_repeats(docs, WordFinder(width), by_spans=False, folder=folder)
