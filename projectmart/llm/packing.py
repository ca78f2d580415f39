"""Packing by shortest-pack-first over the histogram of lengths.

One map over the documents makes tokens and cuts each document into full pieces of the capacity and
a rest. It numbers the pieces of each length inside its task; the pieces are written, without their
tokens, as rows of a few numbers. The histogram of lengths has one row per length, so it may come to
the driver whatever the size of the corpus: there, lengths are placed longest first into the
shortest packs with room, whole counts of equal packs at a time, which gives few packing patterns.
The rank of a piece among those of its length is its number in the task and the counts of the tasks
before; ranges of ranks belong to slots of patterns.

Defined results: a null text is empty and has the end id alone. Repeated rows are packed each. Null
ids are kept. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from projectmart.llm.storage import stored, work_folder
from projectmart.llm.tokens import document_ids

CAPACITY = 1024
END = 0
BLOCK_ROWS = 1024

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint,"
    " task bigint, nth bigint"
)
PACKED = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint,"
    " sequence_id bigint, offset bigint"
)


def _pieces(name: str, capacity: int):
    def run(batches):
        task, seen, rows = TaskContext.get().partitionId(), defaultdict(int), []
        for doc, tokens in document_ids(batches, name, END):
            n = len(tokens)
            for start in range(0, n, capacity):
                piece = tokens[start : start + capacity]
                length = len(piece)
                rows.append((doc, start, length, zlib.crc32(piece), n, task, seen[length]))
                seen[length] += 1
            if len(rows) >= BLOCK_ROWS:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = "doc_id start length ids_crc32 doc_tokens task nth".split()
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Packing patterns (lengths of a pack) and their counts for a histogram of lengths."""
    # Equal packs by the room that they have left.
    open_packs: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max((r for r, packs in open_packs.items() if packs and r >= length), default=0)
            if not room:
                open_packs[capacity - length].append(((length,), left))
                break
            lengths, count = open_packs[room].pop()
            used = min(count, left)
            if used < count:
                open_packs[room].append((lengths, count - used))
            open_packs[room - length].append(((*lengths, length), used))
            left -= used
    return sorted(p for packs in open_packs.values() for p in packs)


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """For each length the rows (first rank, first sequence, offset), by rank: a range of ranks
    belongs to one place in the packs of one pattern."""
    used, first, out = defaultdict(int), 0, defaultdict(list)
    for lengths, count in patterns:
        offset = 0
        for length in lengths:
            out[length].append((used[length], first, offset))
            used[length] += count
            offset += length
        first += count
    return {length: np.array(rows, np.int64) for length, rows in out.items()}


def _placed(broadcast):
    def run(batches):
        places = broadcast.value
        for batch in batches:
            length = batch.column(2).to_numpy()
            rank = batch.column(5).to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length).tolist():
                at, rows = np.flatnonzero(length == n), places[n]
                slot = rows[np.searchsorted(rows[:, 0], rank[at], "right") - 1]
                sequence[at] = slot[:, 1] + rank[at] - slot[:, 0]
                offset[at] = slot[:, 2]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                names=[*batch.schema.names[:5], "sequence_id", "offset"],
            )

    return run


def pack(docs: DataFrame, name: str, capacity: int = CAPACITY, folder: str | None = None) -> DataFrame:
    """One row per piece with its place: columns of ``PACKED``."""
    spark = docs.sparkSession
    folder = folder or work_folder(spark)
    pieces = docs.select("doc_id", "text").mapInArrow(_pieces(name, capacity), PIECES)
    pieces = stored(pieces, f"{folder}/pieces")
    per_task = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    per_task = stored(per_task, f"{folder}/counts")
    # At most ``capacity`` rows, whatever the input.
    histogram = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = spark.sparkContext.broadcast(slots(shortest_pack_first(histogram, capacity)))
    before = Window.partitionBy("length").orderBy("task")
    firsts = per_task.select(
        "task", "length", (F.sum("n").over(before) - F.col("n")).alias("first_rank")
    )
    ranked = pieces.join(firsts, ["task", "length"]).select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        (F.col("first_rank") + F.col("nth")).alias("rank"),
    )
    return ranked.mapInArrow(_placed(places), PACKED)
