"""Benchmark decontamination by Wu-Manber search over words.

Test strings are windows of ten consecutive words of an item; an item of fewer words is one test
string. For each length, a shift table over pairs of words says how far the search may jump: only
positions whose last pair ends some test string have shift zero. There, the bucket of the hash of
that pair, the suffix, selects the test strings; within it they are sorted by the hash of all their
words, and those of the right hash are compared byte by byte.

The search runs inside one map over the documents, without a shuffle. Long items are cut into
segments that overlap by a window less one word, equal segments of an item count once, and
segments are dealt into blocks of about ``BLOCK_WORDS`` words, and about ``BLOCK_BYTES`` bytes where words are long
(text without white space is one word). Each block is one pass; with several, the documents
that a pass finds are stored before the next, so what is held and broadcast is that of one block
however large the benchmark is. Tables hold numbers and one copy of the text, no object per window.

Defined results: null texts have no words, and items without words are never found. The words of
items without an id are hits like any other, but add no id to the list. Repeated items count once,
repeated documents are judged one by one, and empty tables give no rows or no hits. Items of equal
id are one. A document is searched whole, with about 100 bytes of arrays per word.
"""

from __future__ import annotations

import pickle
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from projectmart.llm.arrays import (
    SpanHash,
    blocks,
    byte_table,
    lower_table,
    mix,
    windows,
    word_spans,
)
from projectmart.llm.storage import stored, work_folder

WINDOW = 10
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Words of a segment of an item, and of the segments of one pass.
SEGMENT = 10_000
BLOCK_WORDS = 200_000
BLOCK_BYTES = 8 << 20
# Positions that one lane of the search walks over.
LANE = 256
FOUND = [
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_words", T.ArrayType(T.LongType())),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("no_id", T.BooleanType()),
]


def _words(data, offsets, hasher):
    lowered = lower_table()[data]
    starts, ends, text = word_spans(lowered, offsets, byte_table("alnum"))
    return lowered, starts, ends, text, hasher.spans(hasher.prefix(lowered), starts, ends)


class Patterns:
    """The tables of all test strings of one length, in words.

    ``first`` are the words at which windows start, ``words`` the hashes of all words; ``starts`` and
    ``ends`` say where words stand in ``text``, ``item`` of which item they are.
    """

    def __init__(self, length: int, first: np.ndarray, words, starts, ends, text: bytes, item):
        self.length, self.pair = length, min(2, length)
        hashes = words[first[:, None] + np.arange(length)]
        names = windows_of(hashes)
        order = np.argsort(names, kind="stable")
        low, high = starts[first], ends[first + length - 1]
        # Windows of equal words become one; those that only share the hash stay apart.
        new = np.append(True, names[order][1:] != names[order][:-1])
        for i in np.flatnonzero(~new).tolist():
            x, y = order[i - 1], order[i]
            new[i] = text[low[x] : high[x]] != text[low[y] : high[y]]
        one = order[new]
        of = np.cumsum(new) - 1
        pairs = np.unique(np.stack([of, item[first[order]]], axis=1), axis=0)
        most = length - self.pair + 1
        self.mask = np.uint64((1 << max(12, (8 * len(one)).bit_length())) - 1)
        self.shift = np.full(int(self.mask) + 1, most, np.uint8)
        for j in range(self.pair - 1, length):
            slots = self.slots(hashes[one, j - self.pair + 1], hashes[one, j])
            np.minimum.at(self.shift, slots, np.uint8(length - 1 - j))
        # Buckets of the suffix hash, in each of them by the hash of the window.
        slot = self.slots(hashes[one, length - self.pair], hashes[one, length - 1])
        sort = np.lexsort((names[one], slot))
        self.keys = names[one][sort]
        self.bucket = np.searchsorted(slot[sort], np.arange(int(self.mask) + 2)).astype(np.int32)
        self.text, self.low, self.high = text, low[one][sort], high[one][sort]
        back = np.empty(len(sort), np.int64)
        back[sort] = np.arange(len(sort))
        pairs = pairs[np.argsort(back[pairs[:, 0]], kind="stable")]
        self.item = pairs[:, 1]
        self.item_at = np.searchsorted(back[pairs[:, 0]], np.arange(len(sort) + 1))

    def string(self, k: int) -> bytes:
        return self.text[self.low[k] : self.high[k]]

    def items(self, k: int) -> list[int]:
        return self.item[self.item_at[k] : self.item_at[k + 1]].tolist()

    def select(self, words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of windows that start at ``at``, those whose hash is in the bucket of their suffix, with
        the first test string of that hash and the end of the bucket."""
        last = at + self.length - 1
        slot = self.slots(words[last - self.pair + 1], words[last])
        low, stop = self.bucket[slot].astype(np.int64), self.bucket[slot + 1].astype(np.int64)
        high, key = stop.copy(), windows(words, self.length)[at]
        while (going := low < high).any():
            middle = (low + high) // 2
            less = going & (self.keys[np.minimum(middle, len(self.keys) - 1)] < key)
            low = np.where(less, middle + 1, low)
            high = np.where(going & ~less, middle, high)
        same = (low < stop) & (self.keys[np.minimum(low, len(self.keys) - 1)] == key)
        return at[same], low[same], stop[same]

    def slots(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        joint = last if self.pair == 1 else first * np.uint64(31) + last
        return (mix(joint) & self.mask).astype(np.int64)

    def candidates(self, words: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Start words of windows whose last pair ends a test string, by jumps of the shift table.

        ``low`` and ``high`` bound the words of each text.
        """
        first, stop = low + self.length - 1, high
        long = first < stop
        first, stop = first[long], stop[long]
        # Long texts are walked by several lanes at once.
        lanes = (stop - first + LANE - 1) // LANE
        text = np.repeat(np.arange(len(first)), lanes)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = first[text] + nth * LANE
        stop = np.minimum(at + LANE, stop[text])
        found = []
        while len(at):
            jump = self.shift[self.slots(words[at - self.pair + 1], words[at])]
            found.append(at[jump == 0])
            at = at + np.maximum(jump, 1)
            going = at < stop
            at, stop = at[going], stop[going]
        found = np.concatenate(found) if found else np.zeros(0, np.int64)
        return found - self.length + 1


def windows_of(hashes: np.ndarray) -> np.ndarray:
    """The hash of each row of words, equal to that of ``windows`` over a text."""
    return windows(hashes.reshape(-1), hashes.shape[1])[:: hashes.shape[1]]


def build_patterns(rows: list[tuple[str | None, bytes]]) -> tuple[list[str | None], list[Patterns]]:
    """Names of items, and tables from (item id, words joined by spaces) for each length that occurs."""
    if not rows:
        return [], []
    names = sorted({i for i, _ in rows}, key=lambda i: (i is None, i or ""))
    number = {name: k for k, name in enumerate(names)}
    data = np.frombuffer(b"".join(text for _, text in rows), np.uint8)
    offsets = np.cumsum([0, *(len(text) for _, text in rows)])
    lowered, starts, ends, text, words = _words(data, offsets, SpanHash())
    bounds = np.searchsorted(text, np.arange(len(rows) + 1))
    size = np.diff(bounds)
    item = np.array([number[i] for i, _ in rows], np.int64)[text]
    out = []
    for width in np.unique(np.minimum(size, WINDOW)).tolist():
        chosen = np.flatnonzero(np.minimum(size, WINDOW) == width)
        n = size[chosen] - width + 1
        first = np.repeat(bounds[chosen], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        if width:
            out.append(Patterns(width, first, words, starts, ends, lowered.tobytes(), item))
    return names, out


def _search(tables: list[Patterns], data, offsets, hasher):
    """Words per text, hit words as (text, index in text), items as (text, item)."""
    lowered, starts, ends, text, words = _words(data, offsets, hasher)
    n_texts = len(offsets) - 1
    bounds = np.searchsorted(text, np.arange(n_texts + 1))
    buffer, cover, found = lowered.tobytes(), np.zeros(len(words) + 1, np.int64), set()
    for table in tables:
        at = table.candidates(words, bounds[:-1], bounds[1:])
        if not len(at):
            continue
        for i, k, stop in zip(*(x.tolist() for x in table.select(words, at))):
            string, key = b" ".join(buffer[starts[j] : ends[j]] for j in range(i, i + table.length)), table.keys[k]
            # Test strings of equal hash stand next to each other.
            while k < stop and table.keys[k] == key:
                if table.string(k) == string:
                    cover[i] += 1
                    cover[i + table.length] -= 1
                    found.update((int(text[i]), item) for item in table.items(k))
                    break
                k += 1
    hit = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
    return np.diff(bounds), text[hit], hit - bounds[text[hit]], found


def _searcher(broadcast, carry: list[str], only_found: bool = False):
    def run(batches):
        hasher, (item_names, tables) = SpanHash(), pickle.loads(broadcast.value)
        for rows, data, offsets in blocks(batches):
            n_words, in_text, hit, found = _search(tables, data, offsets, hasher)
            n = rows.num_rows
            hits, items = [[] for _ in range(n)], [[] for _ in range(n)]
            no_id = [False] * n
            for t, h in zip(in_text.tolist(), hit.tolist()):
                hits[t].append(h)
            for t, item in found:
                if item_names[item] is None:
                    no_id[t] = True
                else:
                    items[t].append(item_names[item])
            names = rows.schema.names
            out = pa.RecordBatch.from_arrays(
                [
                    *(rows.column(names.index(c)) for c in carry),
                    pa.array(n_words, pa.int64()),
                    pa.array(hits, pa.list_(pa.int64())),
                    pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                    pa.array(no_id, pa.bool_()),
                ],
                names=[*carry, "n_words", "hit_words", "items", "no_id"],
            )
            yield out.filter(pa.array([len(h) > 0 for h in hits])) if only_found else out

    return run


def words_of(text: Column) -> Column:
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def segments(benchmark: DataFrame) -> DataFrame:
    """(item_id, words, n): the different segments of items, words joined by spaces."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("w"))
    last = F.greatest(F.size("w") - WINDOW, F.lit(0))
    first = F.explode(F.sequence(F.lit(0), last, F.lit(SEGMENT)))
    cut = items.filter(F.size("w") > 0).select("item_id", "w", first.alias("first"))
    part = F.slice("w", F.col("first") + 1, SEGMENT + WINDOW - 1)
    return cut.select(
        "item_id", F.array_join(part, " ").alias("words"), F.size(part).cast("long").alias("n")
    ).distinct()


def _block(spark, tests: DataFrame, block: int, n_blocks: int):
    """The broadcast tables of one block."""
    own = F.pmod(F.xxhash64("item_id", "words"), F.lit(n_blocks)) == block
    rows = tests.filter(own).select("item_id", F.col("words").cast("binary")).collect()
    tables = build_patterns([(r["item_id"], bytes(r["words"])) for r in rows])
    return spark.sparkContext.broadcast(pickle.dumps(tables))


def find_contamination(docs: DataFrame, benchmark: DataFrame, carry: list[str]) -> DataFrame:
    """The columns ``carry`` of ``docs``, each as ``c_`` and its name, with ``n_words``, ``hit_words``
    (word numbers inside any occurrence), ``items`` (ids of items that occur, as strings, sorted) and
    ``no_id`` (whether one without an id occurs)."""
    spark = docs.sparkSession
    folder = work_folder(spark)
    tests = stored(segments(benchmark), f"{folder}/segments")
    sizes = tests.agg(F.sum("n"), F.sum(F.octet_length("words"))).first()
    n_blocks = max(1, *(-(-(size or 0) // most) for size, most in zip(sizes, (BLOCK_WORDS, BLOCK_BYTES))))
    fields = {f.name: f for f in docs.schema.fields}
    # The names of the result must not clash with columns of the input.
    plain = docs.select(F.col("text"), *(F.col(f"`{c}`").alias(f"c_{c}") for c in carry))
    kept = [f"c_{c}" for c in carry]
    if n_blocks == 1:
        schema = T.StructType([T.StructField(f"c_{c}", fields[c].dataType) for c in carry] + FOUND)
        return plain.mapInArrow(_searcher(_block(spark, tests, 0, 1), kept), schema)

    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    texts = docs.select("text", digest.alias("digest"))
    schema = T.StructType([T.StructField("digest", T.StringType()), *FOUND])
    passes = []
    for block in range(n_blocks):
        sent = _block(spark, tests, block, n_blocks)
        found = texts.mapInArrow(_searcher(sent, ["digest"], only_found=True), schema)
        # Copies of a text are found alike.
        once = found.groupBy("digest").agg(*[F.first(c).alias(c) for c in ("hit_words", "items", "no_id")])
        passes.append(stored(once, f"{folder}/found-{block}"))
        sent.unpersist()

    def merged(column: str) -> Column:
        return F.array_sort(F.array_distinct(F.flatten(F.collect_list(column)))).alias(f"all_{column}")

    # At most one row per block for each text.
    found = reduce(DataFrame.unionByName, passes).groupBy("digest").agg(
        merged("hit_words"), merged("items"), F.bool_or("no_id").alias("any_no_id")
    )
    joined = plain.withColumn("digest", digest).join(found, "digest", "left")
    return joined.select(
        *kept,
        F.size(words_of(F.coalesce("text", F.lit("")))).cast("long").alias("n_words"),
        F.coalesce("all_hit_words", F.array().cast("array<bigint>")).alias("hit_words"),
        F.coalesce("all_items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("any_no_id", F.lit(False)).alias("no_id"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no test string occurs, with the columns of ``docs``."""
    found = find_contamination(docs, benchmark, docs.columns)
    clean = found.filter(F.size("hit_words") == 0)
    return clean.select(*(F.col(f"`c_{c}`").alias(c) for c in docs.columns))
