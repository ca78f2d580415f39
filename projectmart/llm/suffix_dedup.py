"""Exact substring dedup by suffix arrays of shards.

Keys that sort out candidates are the least hashes of the byte runs inside each window, so a window
has the same key wherever it stands, and neighbouring windows share it. For the candidate regions of
a shard a suffix array is built by Larsson-Sadakane refinement: suffixes are sorted by their first
eight bytes, then groups that are not yet sorted are refined by the ranks of the suffixes 8, 16, 32,
... bytes on. Kasai's lemma gives the common prefixes of neighbours: they are compared byte by byte
only where the bytes before differ, and lose one byte per step elsewhere. Equal stretches and equal
windows of a shard are neighbours in the array whose common prefix is long enough; one name per class
goes on to be merged with those of the other shards by binary search (see ``repeats``).

Defined results: a null text is empty. A null id is the smallest. Rows of equal ids do not remove
each other's bytes. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from projectmart.llm.arrays import CACHED, SpanHash
from projectmart.llm.repeats import covered_runs, remove_repeats

WIDTH = 50
# Bytes of the runs whose least hash is the key of a window.
GRAM = 26


# The least numbers of one byte, of two, ... of eight.
_BYTE_SIZES = np.uint64(1) << np.arange(0, 64, 8, dtype=np.uint64)


def words_of_eight(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on as one number, in byte order; zeros after the end."""
    padded = np.zeros(len(data) + 16, np.uint8)
    padded[: len(data)] = data
    out = np.zeros(len(data), np.uint64)
    for j in range(min(8, len(data))):
        n = (len(data) - j + 7) // 8
        out[j::8] = padded[j : j + 8 * n].view(">u8")
    return out


def suffix_array(data: np.ndarray, eight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the rank of each, by refining groups that are not sorted yet."""
    n = len(data)
    order = np.argsort(eight)
    if n < 1 << 29:
        order = order.astype(np.int32)
    # The rank of a suffix is where its group starts; suffixes of fewer than eight bytes may tie
    # with zero bytes and are told apart by the refinement, as nothing comes after their end.
    start = np.append(True, eight[order][1:] != eight[order][:-1]) if n else np.zeros(0, bool)
    rank = np.empty(n, order.dtype)
    rank[order] = np.maximum.accumulate(np.where(start, np.arange(n), 0))
    shift = 8
    # The last suffixes are shorter than the bytes compared so far.
    open_slots = np.flatnonzero(~start | ~np.append(start[1:], True)) if n else np.zeros(0, np.int64)
    while len(open_slots):
        suffix = order[open_slots]
        after = suffix.astype(np.int64) + shift
        # A suffix that ends within the bytes compared comes first, the shorter one before.
        second = np.where(after < n, shift + 1 + rank[np.minimum(after, n - 1)], n - suffix)
        joint = rank[suffix].astype(np.int64) * (2 * n + shift + 1) + second
        sort = np.argsort(joint)
        suffix, joint = suffix[sort], joint[sort]
        order[open_slots] = suffix
        new = np.append(True, joint[1:] != joint[:-1])
        rank[suffix] = np.maximum.accumulate(np.where(new, open_slots, 0))
        alone = new & np.append(new[1:], True)
        open_slots = open_slots[~alone]
        shift *= 2
    return order, rank


def common_prefixes(data: np.ndarray, eight: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each suffix of the array and the one before it."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64)
    a, b = order[1:], order[:-1]
    different = (a == 0) | (b == 0) | (data[a - 1] != data[b - 1])
    i, j = a[different], b[different]
    reach = np.zeros(len(i), order.dtype)
    active = np.arange(len(i), dtype=order.dtype)
    while len(active):
        x, y = i[active] + reach[active], j[active] + reach[active]
        inside = (x < n) & (y < n)
        active, x, y = active[inside], x[inside], y[inside]
        differ = eight[x] ^ eight[y]
        # Equal leading bytes of two numbers; not beyond the end of the text.
        equal = 8 - np.searchsorted(_BYTE_SIZES, differ, "right")
        equal = np.minimum(equal, np.minimum(n - x, n - y))
        reach[active] += equal
        active = active[equal == 8]
    at = np.zeros(n, order.dtype)
    at[i] = i + reach
    by_position = np.maximum(np.maximum.accumulate(at) - np.arange(n, dtype=order.dtype), 0)
    prefixes = np.zeros(n, order.dtype)
    prefixes[1:] = by_position[a]
    return prefixes


class Regions:
    """The suffix array of the parts of a shard that hold candidate windows."""

    def __init__(self, data: np.ndarray, start: np.ndarray, length: np.ndarray):
        order = np.argsort(start, kind="stable")
        low, high = start[order], np.maximum.accumulate((start + length)[order])
        new = np.append(True, low[1:] > high[:-1])[: len(low)]
        # Where regions start in the shard and, without what is between them, in the text of regions.
        self._low = low[new]
        sizes = high[np.append(new[1:], True)[: len(low)]] - self._low
        self._moved = self._low - (np.cumsum(sizes) - sizes)
        text = data[np.repeat(self._moved, sizes) + np.arange(sizes.sum())]
        eight = words_of_eight(text)
        order, self._rank = suffix_array(text, eight)
        self._prefixes = common_prefixes(text, eight, order)

    def classes(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Equal numbers, from 0 without gaps, for equal strings."""
        region = np.searchsorted(self._low, start, "right") - 1
        rank = self._rank[start - self._moved[region]]
        order = np.lexsort((rank, length))
        rank, length = rank[order], length[order]
        same = np.zeros(len(order), bool)
        pair = np.flatnonzero((length[1:] == length[:-1]) & (rank[1:] != rank[:-1]))
        if len(pair):
            cuts = np.stack([rank[pair] + 1, rank[pair + 1] + 1], axis=1).ravel()
            # The last cut may be the end of the array.
            least = np.minimum.reduceat(np.append(self._prefixes, 0), cuts)[::2]
            same[pair + 1] = least >= length[pair]
        same[1:] |= (length[1:] == length[:-1]) & (rank[1:] == rank[:-1])
        out = np.empty(len(order), np.int64)
        out[order] = np.cumsum(~same) - 1
        return out


class Bytes:
    """The windows of the texts of a shard."""

    def __init__(self, data, offsets, width: int, hasher: SpanHash):
        self.data, self.offsets, self.width, self._hasher = data, offsets, width, hasher
        self._sums = hasher.prefix(data)

    def stretches(self):
        """(key, first window, number of windows, text) of runs of windows of equal keys."""
        n = len(self.data) - self.width + 1
        none = np.zeros(0, np.int64)
        if n <= 0:
            return none.astype(np.uint64), none, none, none
        # Windows lie inside one text: where those of a text start, and where those across its end.
        sizes = np.maximum(np.diff(self.offsets) - self.width + 1, 0)
        bounds = self.offsets[:-1][sizes > 0]
        new = np.zeros(n + 1, bool)
        new[bounds] = new[bounds + sizes[sizes > 0]] = True
        keys, last = [], None
        for low in range(0, n, CACHED):
            part = self._keys(low, min(low + CACHED, n))
            here = new[low : low + len(part)]
            here[1:] |= part[1:] != part[:-1]
            here[0] |= part[0] != last
            keys.append(part[here])
            last = part[-1]
        new[n] = True
        first = np.flatnonzero(new)
        length = np.diff(first)
        first = first[:-1]
        text = np.searchsorted(self.offsets, first, "right") - 1
        inside = first < self.offsets[text] + sizes[text]
        return np.concatenate(keys)[inside], first[inside], length[inside], text[inside]

    def _keys(self, low: int, high: int) -> np.ndarray:
        """Keys of the windows from ``low`` to ``high``."""
        gram = min(GRAM, self.width)
        size, want = 1, self.width - gram + 1
        least = self._hasher.runs(self._sums, low, high + want - 1, gram)
        while 2 * size <= want:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < want:
            least = np.minimum(least[: len(least) - (want - size)], least[want - size :])
        return least

    def span_classes(self, start, length):
        size = length + self.width - 1
        return Regions(self.data, start, size).classes(start, size)

    def span_names(self, start, length):
        return self._hasher.spans(self._sums, start, start + length + self.width - 1)

    def window_classes(self, start):
        size = np.full(len(start), self.width)
        return Regions(self.data, start, size).classes(start, size)

    def window_names(self, start):
        return self._hasher.spans(self._sums, start, start + self.width)

    def results(self, removed):
        gone, runs = covered_runs(len(self.data), self.offsets, removed, self.width)
        kept = self.data[~gone].tobytes()
        at = np.append(0, np.cumsum(~gone, dtype=np.int32))[self.offsets]
        return [
            pa.array(np.diff(self.offsets), pa.int64()),
            runs,
            pa.array([kept[a:b] for a, b in zip(at[:-1], at[1:])], pa.binary()),
        ]


class ByteFinder:
    def __init__(self, width: int = WIDTH):
        self.width, self._hasher = width, None

    def parse(self, data, offsets) -> Bytes:
        self._hasher = self._hasher or SpanHash()
        return Bytes(data, offsets, self.width, self._hasher)


def dedup_substrings(docs: DataFrame, width: int = WIDTH, folder: str | None = None) -> DataFrame:
    """(doc_id, n_units, removed, kept): bytes of the text, removed runs of bytes, bytes that stay."""
    return remove_repeats(docs, ByteFinder(width), by_spans=True, folder=folder)
