"""Bounded-space online best-fit packing.

One map over the documents makes tokens and places each document as it comes: into the open bin with
the least free space that still holds it. Open bins are kept by their free space, and a bitset with
one bit for each amount of free space finds the bin in one step. Their number is fixed; when a new
bin is needed and none may be opened, the fullest closes. Only longer documents are cut.

A task ends with open bins. What they hold is placed once more by the same rule, longest first, in
teams of ``TEAM`` tasks, so that the loss does not grow with the number of tasks; everything else is
final when its bin closes. A task holds the open bins only, at most ``OPEN`` times ``CAPACITY`` pieces.

Defined results: a null text is empty and has the end id alone. Repeated rows and rows of equal ids
are packed each, null ids are kept, and of bins with equal room the latest is taken. An empty table
gives no rows. A text of any length is held whole, as text, chunks and tokens.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from projectmart.llm.storage import stored, work_folder
from projectmart.llm.tokens import document_ids

CAPACITY = 2048
OPEN = 256
# Tasks whose open bins are placed anew together.
TEAM = 8
END = 0
BLOCK_BINS = 512
# Sequences of one task have numbers of so many bits.
TASK_BITS = 33

PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PLACE = "sequence_id bigint, offset bigint"
FIRST_PASS = f"{PIECE}, {PLACE}, task bigint, open boolean"


class Bins:
    """Open bins by free space. Bit f of ``mask`` says whether some open bin has f free."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most, self.n_open, self.mask = capacity, most, 0, 0
        self.by_free: dict[int, list[list]] = {}

    def _take(self, free: int) -> list:
        bins = self.by_free[free]
        held = bins.pop()
        if not bins:
            del self.by_free[free]
            self.mask ^= 1 << free
        self.n_open -= 1
        return held

    def place(self, length: int, item) -> list[list]:
        """Put ``item`` into a bin; return the bins that close by that."""
        closed, fitting = [], self.mask >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            held = self._take(free)
        else:
            free, held = self.capacity, []
        held.append(item)
        free -= length
        if not free:
            return [held]
        if self.n_open == self.most:
            fullest = (self.mask & -self.mask).bit_length() - 1
            if free <= fullest:
                return [held]
            closed.append(self._take(fullest))
        self.by_free.setdefault(free, []).append(held)
        self.mask |= 1 << free
        self.n_open += 1
        return closed

    def rest(self) -> list[list]:
        """The bins still open, fullest first."""
        return [held for free in sorted(self.by_free) for held in self.by_free[free]]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; all but the first are full."""
    first = n % capacity or capacity
    return [(0, first), *((start, capacity) for start in range(first, n, capacity))]


def _rows(closed: list[list], first: int) -> list[tuple]:
    """Rows of closed bins, whose sequences are numbered from ``first``."""
    rows = []
    for sequence, held in enumerate(closed, first):
        offset = 0
        for piece in held:
            rows.append((*piece, sequence, offset))
            offset += piece[3]
    return rows


def _batch(rows: list[tuple], **constants) -> pa.RecordBatch:
    names = "doc_id piece start length ids_crc32 sequence_id offset".split()
    kinds = {"piece": pa.int32()}
    columns = [pa.array(c, kinds.get(n, pa.int64())) for n, c in zip(names, zip(*rows))]
    columns += [pa.array([value] * len(rows)) for value in constants.values()]
    return pa.RecordBatch.from_arrays(columns, names=[*names, *constants])


def _packer(name: str, capacity: int, most: int):
    def run(batches):
        task, closed = TaskContext.get().partitionId(), []
        bins, number = Bins(capacity, most), task << TASK_BITS
        for doc, tokens in document_ids(batches, name, END):
            for nth, (start, length) in enumerate(cut(len(tokens), capacity)):
                crc = zlib.crc32(tokens[start : start + length])
                closed += bins.place(length, (doc, nth, start, length, crc))
            if len(closed) >= BLOCK_BINS:
                yield _batch(_rows(closed, number), task=task, open=False)
                number += len(closed)
                closed = []
        if closed:
            yield _batch(_rows(closed, number), task=task, open=False)
            number += len(closed)
        if rest := bins.rest():
            yield _batch(_rows(rest, number), task=task, open=True)

    return run


def _placed_again(capacity: int, most: int):
    def run(batches):
        bins, team, nth = Bins(capacity, most), None, 0

        def numbered(closed):
            # Below zero, apart from the sequences that closed in the first pass.
            return _batch(_rows(closed, -((team + 1) << TASK_BITS) + nth))

        for batch in batches:
            closed, pieces = [], zip(*(batch.column(i).to_pylist() for i in range(5)))
            for of, piece in zip(batch.column(5).to_pylist(), pieces):
                if of != team:
                    if closed := closed + bins.rest():
                        yield numbered(closed)
                    bins, team, nth, closed = Bins(capacity, most), of, 0, []
                closed += bins.place(piece[3], piece)
            if closed:
                yield numbered(closed)
                nth += len(closed)
        if rest := bins.rest():
            yield numbered(rest)

    return run


def pack(
    docs: DataFrame,
    name: str,
    capacity: int = CAPACITY,
    most_open: int = OPEN,
    folder: str | None = None,
) -> DataFrame:
    """One row per piece with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    folder = folder or work_folder(docs.sparkSession)
    texts = docs.select("doc_id", "text")
    placed = stored(texts.mapInArrow(_packer(name, capacity, most_open), FIRST_PASS), f"{folder}/placed")
    pieces = [c.split()[0] for c in PIECE.split(", ")]
    left = placed.filter("open").select(*pieces, F.floor(F.col("task") / TEAM).cast("bigint").alias("team"))
    left = left.repartition("team").sortWithinPartitions("team", F.desc("length"), "doc_id", "piece")
    again = left.mapInArrow(_placed_again(capacity, most_open), f"{PIECE}, {PLACE}")
    return placed.filter("NOT open").select(again.columns).unionByName(again)
