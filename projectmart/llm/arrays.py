"""Whole texts as byte arrays: words, hashes and windows without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are worked on in blocks of about this many bytes; a longer text is a block of its own.
BLOCK_BYTES = 2 << 20

# Elements of a part whose arrays stay in the processor's cache.
CACHED = 1 << 14

BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD1342543DE82EF95
MASK = (1 << 64) - 1


def byte_table(pattern: str) -> np.ndarray:
    """Which bytes belong to words: ``white`` splits at ASCII white space, ``alnum`` keeps digits,
    letters and all bytes of characters beyond ASCII."""
    table = np.zeros(256, bool)
    if pattern == "white":
        table[:] = True
        table[[32, *range(9, 14)]] = False
    else:
        table[128:] = True
        table[ord("0") : ord("9") + 1] = True
        table[ord("a") : ord("z") + 1] = True
        table[ord("A") : ord("Z") + 1] = True
    return table


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    return table


def binary(column) -> pa.Array:
    """A text column as bytes, null as empty."""
    return pc.fill_null(column.cast(pa.large_binary()), b"")


def blocks(
    batches: Iterator[pa.RecordBatch], text: str = "text", most: int = BLOCK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, their texts as one byte array, offsets of the texts in it)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        texts = binary(batch.column(batch.schema.get_field_index(text)))
        _, at, data = texts.buffers()
        offsets = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        low = 0
        while low < len(texts):
            high = int(np.searchsorted(offsets, offsets[low] + most, "right")) - 1
            high = min(max(high, low + 1), len(texts))
            yield (
                batch.slice(low, high - low),
                data[offsets[low] : offsets[high]],
                offsets[low : high + 1] - offsets[low],
            )
            low = high


def word_spans(data, offsets, table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the index of its text. Words never cross texts."""
    inside = table[data]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    before = np.empty_like(inside)
    before[:1], before[1:] = False, inside[:-1]
    before[cuts] = False
    after = np.empty_like(inside)
    after[-1:], after[:-1] = False, inside[1:]
    after[cuts - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASES = (BYTE_BASE, pow(BYTE_BASE, -1, 1 << 64))


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


class SpanHash:
    """64-bit hashes of spans of byte arrays by prefix sums. A power of the base is the product of
    one of the ``CACHED`` lowest and one of a multiple of ``CACHED``; both tables stay small."""

    def __init__(self):
        self._size, self._part = 0, CACHED
        self._low = [_powers(base, self._part) for base in _BASES]
        self._high = [_powers(pow(base, self._part, 1 << 64), 0) for base in _BASES]

    def _grow(self, n: int) -> None:
        if n <= self._size:
            return
        parts = 2 * n // self._part + 1
        self._size = parts * self._part
        self._high = [_powers(pow(base, self._part, 1 << 64), parts) for base in _BASES]

    def _inverse(self, at: np.ndarray) -> np.ndarray:
        high, low = np.divmod(at, self._part)
        out = self._low[1][low]
        out *= self._high[1][high]
        return out

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        for nth, low in enumerate(range(0, len(data), self._part)):
            part = data[low : low + self._part].astype(np.uint64)
            part += np.uint64(1)
            part *= self._low[0][: len(part)]
            part *= self._high[0][nth]
            part[:1] += sums[low : low + 1]
            np.cumsum(part, out=sums[low + 1 : low + 1 + len(part)])
        return sums

    def spans(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = sums[ends]
        raw -= sums[starts]
        raw *= self._inverse(starts)
        raw += (ends - starts).astype(np.uint64) * np.uint64(WORD_BASE)
        return mix(raw)

    def runs(self, sums: np.ndarray, low: int, high: int, width: int) -> np.ndarray:
        """``spans`` of the ``width`` bytes from each of the places ``low`` to ``high`` on."""
        raw = sums[low + width : high + width] - sums[low:high]
        raw *= self._inverse(np.arange(low, high))
        raw += np.uint64((width * WORD_BASE) & MASK)
        return mix(raw)


def windows(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive values; callers leave out runs across texts."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out = out * np.uint64(WORD_BASE) + values[j : j + n]
    return mix(out)
