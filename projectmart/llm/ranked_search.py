"""Ranked lexical search, term at a time with limited accumulators.

An index is built in one map over the documents: every task cuts its texts into shards of a bounded
number of bytes, and a shard is one row with the terms, the lists of documents and the counts. An
index row needs no other row, so nothing is shuffled, and a lost one is built again from its texts.

A search sends a bounded block of items to all shards. In a shard the terms of an item are taken
rarest first. Each adds its part to the accumulators of its documents; once what the remaining terms
can still give falls below the k-th partial score, no document without an accumulator can be among
the best k, so none is created any more and the others are carried on exactly. The best k of each
shard are merged by rank.

Scores are whole numbers, so ties are exact; they go by ascending id, a null id last.

Defined results: a null or empty text has no terms, is never found and finds nothing. Repeated rows
of documents are found each; repeated items are answered each. An empty table gives no rows. Texts of
any length are read whole, in slices of ``SLICE_BYTES`` cut between terms.
"""

from __future__ import annotations

import math
import pickle
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from projectmart.llm.arrays import binary
from projectmart.llm.storage import stored, work_folder

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOP = 10
# Text of a shard, and of one step of reading a long text.
SHARD_BYTES = 16 << 20
SLICE_BYTES = 4 << 20
# Different terms of the items of one pass.
BLOCK_TERMS = 500_000
# Groups in which the best of shards are merged first.
MERGES = 64

INDEX = (
    "ids array<bigint>, lengths binary, n_terms bigint, n_docs bigint,"
    " terms string, counts binary, docs binary, tfs binary"
)


def _byte_classes() -> bytes:
    """A-Z to a-z, all other bytes below 128 that are no part of a term to a space."""
    part = {*range(48, 58), *range(97, 123), *range(128, 256)}
    return bytes(b + 32 if 65 <= b <= 90 else b if b in part else 32 for b in range(256))


CLASSES = _byte_classes()


def text_terms(text: bytes):
    """Lists of the terms of a text, of one slice of it at a time."""
    plain, low = text.translate(CLASSES), 0
    while low < len(plain):
        high = len(plain)
        if high - low > SLICE_BYTES:
            space = plain.find(b" ", low + SLICE_BYTES)
            high = space if space >= 0 else high
        yield plain[low:high].split()
        low = high


class _Shard:
    """Documents on the way to one row of the index."""

    def __init__(self):
        self.numbers = defaultdict(count().__next__)
        self.ids, self.lengths, self.keys, self.counts, self.bytes = [], [], [], [], 0

    def add(self, doc, text: bytes) -> None:
        nth, n = len(self.ids), 0
        for terms in text_terms(text):
            numbers = np.fromiter(map(self.numbers.__getitem__, terms), np.int64, len(terms))
            found, counts = np.unique(numbers, return_counts=True)
            self.keys.append(found << 32 | nth)
            self.counts.append(counts)
            n += len(terms)
        self.ids.append(doc)
        self.lengths.append(n)
        self.bytes += len(text)

    def row(self) -> pa.RecordBatch:
        keys = np.concatenate([np.zeros(0, np.int64), *self.keys])
        counts = np.concatenate([np.zeros(0, np.int64), *self.counts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        # Slices of one text may hold the same term.
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else order
        tfs = np.add.reduceat(counts, first) if len(first) else counts
        keys = keys[first]
        per_term = np.bincount(keys >> 32, minlength=len(self.numbers))
        values = [
            pa.array([self.ids], pa.list_(pa.int64())),
            _column(self.lengths, np.int64),
            pa.array([sum(self.lengths)], pa.int64()),
            pa.array([sum(n > 0 for n in self.lengths)], pa.int64()),
            pa.array([b"\n".join(self.numbers).decode()], pa.string()),
            _column(per_term, np.int32),
            _column(keys & 0xFFFFFFFF, np.int32),
            _column(tfs, np.int32),
        ]
        return pa.RecordBatch.from_arrays(values, names=[c.split()[0] for c in INDEX.split(", ")])


def _column(values, kind) -> pa.Array:
    return pa.array([np.asarray(values, kind).tobytes()], pa.binary())


def _indexed(batches):
    shard = _Shard()
    for batch in batches:
        for doc, text in zip(batch.column(0).cast(pa.int64()).to_pylist(), binary(batch.column(1))):
            shard.add(doc, text.as_py() or b"")
            if shard.bytes >= SHARD_BYTES:
                yield shard.row()
                shard = _Shard()
    if shard.ids:
        yield shard.row()


def build_index(docs: DataFrame, path: str) -> DataFrame:
    """The stored index of ``docs`` (doc_id, text), one row per shard."""
    return stored(docs.select("doc_id", "text").mapInArrow(_indexed, INDEX), path)


def _known(sent):
    """Number of documents of each term of the block, (term number, n) for each shard."""

    def run(batches):
        numbers = pickle.loads(sent.value)
        for batch in batches:
            for terms, counts in zip(batch.column(0), batch.column(1)):
                found = [numbers.get(t, -1) for t in terms.as_py().split("\n")]
                found = np.array(found[: len(per := np.frombuffer(counts.as_py(), np.int32))], np.int64)
                at = found >= 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[at]), pa.array(per[at].astype(np.int64))], names=["number", "n"]
                )

    return run


class _Postings:
    """The lists of one shard for the terms of the block."""

    def __init__(self, row: dict, numbers: dict[str, int], n_docs: int, n_terms: int):
        ids = row["ids"]
        self.known = np.array([i is not None for i in ids], bool)
        self.ids = np.array([i or 0 for i in ids], np.int64)
        lengths, counts = (np.frombuffer(row[c], k) for c, k in (("lengths", np.int64), ("counts", np.int32)))
        self.norms = 100 - 75 + 75 * lengths * n_docs // n_terms
        ends = np.cumsum(counts, dtype=np.int64)
        self.docs, self.tfs = (np.frombuffer(row[c], np.int32) for c in ("docs", "tfs"))
        self.at = {
            numbers[t]: (int(end) - int(n), int(end))
            for t, n, end in zip(row["terms"].split("\n"), counts, ends)
            if t in numbers
        }
        self.lists: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}
        self.scores = np.zeros(len(ids), np.int64)

    def of(self, number: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents of a term, their parts before the weight, and the largest part."""
        if number not in self.lists:
            span = slice(*self.at[number])
            docs, tfs = self.docs[span], self.tfs[span].astype(np.int64)
            parts = 1_000_000_000 * tfs // (1000 * tfs + 8 * self.norms[docs])
            self.lists[number] = docs, parts, int(parts.max())
        return self.lists[number]


def kth_largest(scores: np.ndarray, k: int) -> int:
    return int(np.partition(scores, -k)[-k]) if len(scores) >= k else 0


def best(terms: list[tuple[int, int]], shard: _Postings, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Document numbers and scores of the best k of a shard, and what ties with the last of them.

    ``terms`` are (number, weight), rarest first.
    """
    lists = [(weight, *shard.of(number)) for number, weight in terms if number in shard.at]
    left = sum(weight * most for weight, _, _, most in lists)
    scores, kth, taken = shard.scores, 0, 0
    scores[:] = 0
    for weight, docs, parts, most in lists:
        if left < kth:
            break
        scores[docs] += weight * parts
        left -= weight * most
        kth = kth_largest(scores[scores > 0], k)
        taken += 1
    # From here on no accumulator is created; those that cannot reach the k-th are let go.
    docs = np.flatnonzero(scores)
    docs = docs[scores[docs] + left >= kth]
    sums = scores[docs]
    for weight, others, parts, _ in lists[taken:]:
        at = np.minimum(np.searchsorted(others, docs), len(others) - 1)
        same = others[at] == docs
        sums[same] += weight * parts[at[same]]
    high = sums >= max(1, kth_largest(sums, k))
    docs, sums = docs[high], sums[high]
    order = np.lexsort((shard.ids[docs], ~shard.known[docs], -sums))[:k]
    return docs[order], sums[order]


def _searcher(sent, k: int):
    def run(batches):
        numbers, items, n_docs, n_terms = pickle.loads(sent.value)
        for batch in batches:
            for row in batch.to_pylist():
                shard = _Postings(row, numbers, n_docs, n_terms)
                keys, docs, scores = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for key, terms in items:
                    found, sums = best(terms, shard, k)
                    keys += [key] * len(found)
                    docs.append(found)
                    scores.append(sums)
                docs = np.concatenate(docs)
                ids = pa.array(shard.ids[docs], mask=~shard.known[docs])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), ids, pa.array(np.concatenate(scores))],
                    names=["key", "doc_id", "score"],
                )

    return run


def item_terms(items: DataFrame, text: str = "text") -> DataFrame:
    """(key, term, n): how often each term stands in each item."""
    lowered = F.translate(F.col(text), UPPER, LOWER)
    terms = items.select("key", F.explode(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))).alias("term"))
    return terms.groupBy("key", "term").agg(F.count("*").alias("n"))


def _ranked(found: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = TOP, folder: str | None = None) -> DataFrame:
    """The best ``k`` documents of each row of ``items`` (item_id, text): item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    folder = folder or work_folder(spark)
    index = build_index(docs, f"{folder}/index")
    n_docs, n_terms = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    asked = items.select("item_id", "text", F.monotonically_increasing_id().alias("key"))
    asked = stored(asked, f"{folder}/items")
    terms = stored(item_terms(asked), f"{folder}/terms")
    n_blocks = -(-terms.count() // BLOCK_TERMS)
    found = spark.createDataFrame([], "key bigint, doc_id bigint, score bigint")
    for block in range(n_blocks if n_terms else 0):
        own = F.pmod(F.xxhash64("key"), F.lit(n_blocks)) == block
        # Bounded by BLOCK_TERMS and the terms of one item.
        wanted = [tuple(r) for r in terms.filter(own).collect()]
        numbers = {t: i for i, t in enumerate(sorted({term for _, term, _ in wanted}))}
        sent = spark.sparkContext.broadcast(pickle.dumps(numbers))
        known = index.select("terms", "counts").mapInArrow(_known(sent), "number bigint, n bigint")
        df = dict(known.groupBy("number").agg(F.sum("n")).collect())
        by_item = defaultdict(list)
        for key, term, n in wanted:
            if number_df := df.get(numbers[term]):
                weight = n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * number_df + 1)))
                if weight:
                    by_item[key].append((number_df, numbers[term], weight))
        ordered = [(key, [x[1:] for x in sorted(rows)]) for key, rows in sorted(by_item.items())]
        sent = spark.sparkContext.broadcast(pickle.dumps((numbers, ordered, n_docs, n_terms)))
        one = index.mapInArrow(_searcher(sent, k), "key bigint, doc_id bigint, score bigint")
        found = found.union(stored(one, f"{folder}/found-{block}"))
    # The best of groups of shards first, so that no task gets those of all shards.
    group = F.pmod(F.xxhash64("doc_id"), F.lit(MERGES))
    best_of = _ranked(_ranked(found.withColumn("group", group), k, "key", "group"), k, "key")
    return best_of.join(asked.select("key", "item_id"), "key").select("item_id", "rank", "doc_id", "score")
