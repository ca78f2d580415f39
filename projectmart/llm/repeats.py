"""Windows of texts that also start in a document of a smaller id, over shards of whole documents.

What a window is and how windows are named is up to a *finder*; this module moves the names:

1. Every window has a key that depends on the window alone, shared by the windows next to it, so
   that there are far fewer keys than windows. Keys that occur in one document only are settled.
2. Stretches of windows under one repeated key are named by their whole span. A stretch that is
   found in a smaller document is settled; so is one whose key is in no smaller document.
3. Keys with stretches left open name each of their windows.

In every step the shards send sorted names to the bucket of their upper bits, once per shard however
often a name occurs there. A bucket looks the names of each shard up by binary search in the merged
list, and answers with one bit per name, in the order of the question. Shards hold whole documents,
so their number and that of the buckets grow with the input, and their sizes do not. They are
written once, bucketed by shard, so that answers move to the shards and texts stay where they are.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from projectmart.llm.arrays import blocks, mix
from projectmart.llm.storage import stored, work_folder

SHARD_BYTES = 2 << 20
# Text whose names meet in one bucket.
BUCKET_BYTES = 32 << 20
NULL_ID = -(2**63)
# Keys only sort out candidates: 40 bits and those of the bucket will do.
KEY_BITS = 40

ASKED = "bucket int, shard bigint, names binary, extra binary, docs binary"
ANSWERED = "shard bigint, bucket int, bits binary, open binary"


def _zip(values: np.ndarray) -> bytes:
    raw = np.ascontiguousarray(values).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unzip(blob: bytes, kind) -> np.ndarray:
    size = int.from_bytes(blob[:8], "little")
    return np.frombuffer(pa.decompress(blob[8:], size, codec="zstd", asbytes=True), kind)


def _bits(values: np.ndarray) -> bytes:
    return np.packbits(values).tobytes()


def _flags(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(blob, np.uint8), count=n).astype(bool)


def _narrow(keys: np.ndarray) -> bytes:
    """40-bit values in five bytes each."""
    low = keys & np.uint64((1 << KEY_BITS) - 1)
    return (low >> np.uint64(8)).astype("<u4").tobytes() + (low & np.uint64(255)).astype(np.uint8).tobytes()


def _wide(blob: bytes) -> np.ndarray:
    n = len(blob) // 5
    high = np.frombuffer(blob, "<u4", count=n).astype(np.uint64)
    return (high << np.uint64(8)) | np.frombuffer(blob, np.uint8, offset=4 * n).astype(np.uint64)


def _pack(batches):
    task, nth = TaskContext.get().partitionId(), 0
    for rows, data, offsets in blocks(batches, most=SHARD_BYTES):
        ids = rows.column(rows.schema.get_field_index("doc_id")).cast(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([(task << 32) | nth], pa.int64()),
                pa.array([len(data)], pa.int64()),
                pa.array([ids.to_pylist()], pa.list_(pa.int64())),
                pa.array([_zip(offsets)], pa.binary()),
                pa.array([_zip(data)], pa.binary()),
            ],
            names=["shard", "n_bytes", "ids", "offsets", "text"],
        )
        nth += 1


SHARDS = "shard bigint, n_bytes bigint, ids array<bigint>, offsets binary, text binary"


@dataclass
class Shard:
    """A shard in memory, with its windows in stretches of equal keys."""

    number: int
    ids: np.ndarray
    data: np.ndarray
    offsets: np.ndarray
    finder: object
    bucket_bits: int
    answers: list = field(default_factory=list)

    def __post_init__(self):
        self.parsed = self.finder.parse(self.data, self.offsets)
        key, self.start, self.length, text = self.parsed.stretches()
        # A finder may take the least or largest hash of a window: spread the keys over all buckets.
        self.key = mix(key) >> np.uint64(64 - KEY_BITS - self.bucket_bits)
        self.doc = self.ids[text]
        order = np.argsort(self.key)
        sorted_key = self.key[order]
        new = np.append(True, sorted_key[1:] != sorted_key[:-1]) if len(order) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        self.keys = sorted_key[first]
        # For each stretch, the place of its key among the different ones.
        self.key_place = np.empty(len(order), np.int64)
        self.key_place[order] = np.cumsum(new) - 1
        self._order, self._first = order, first

    def several(self) -> np.ndarray:
        """Whether each of the different keys is in several documents of the shard."""
        if not len(self._first):
            return np.zeros(0, bool)
        doc = self.doc[self._order]
        return np.minimum.reduceat(doc, self._first) != np.maximum.reduceat(doc, self._first)

    def cuts(self, names: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
        """(bucket, low, high) of sorted names whose upper bits, above ``bits``, are the bucket."""
        bucket = (names >> np.uint64(bits)).astype(np.int64) if bits < 64 else np.zeros(len(names), np.int64)
        numbers, low = np.unique(bucket, return_index=True)
        return list(zip(numbers.tolist(), low.tolist(), [*low[1:].tolist(), len(names)]))

    def answer(self, step: int, cuts, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Both bits of each of the ``n`` names that were asked for in a step."""
        by_bucket = {a["bucket"]: a for a in self.answers[step] or ()}
        bits, still_open = np.zeros(n, bool), np.zeros(n, bool)
        for bucket, low, high in cuts:
            a = by_bucket[bucket]
            bits[low:high] = _flags(a["bits"], high - low)
            if a["open"]:
                still_open[low:high] = _flags(a["open"], high - low)
        return bits, still_open

    # Step 1: keys.
    def key_cuts(self):
        return self.cuts(self.keys, KEY_BITS)

    def ask_keys(self):
        several = self.several()
        for bucket, low, high in self.key_cuts():
            yield bucket, _narrow(self.keys[low:high]), _bits(several[low:high]), b""

    def repeated(self) -> np.ndarray:
        """Numbers of the stretches whose key occurs in several documents."""
        bits, _ = self.answer(0, self.key_cuts(), len(self.keys))
        return np.flatnonzero(bits[self.key_place])

    # Step 2: stretches.
    def spans(self, compare=None):
        """Candidate stretches, their places among the different (key, name) of the shard, and of
        those key, name and smallest document.

        With ``compare``, only one stretch of each class of equal spans is named.
        """
        at = self.repeated()
        place, first = _classes(compare, self.start[at], self.length[at])
        name = self.parsed.span_names(self.start[at][first], self.length[at][first])
        key = self.key[at][first]
        order = np.lexsort((name, key))
        key, name = key[order], name[order]
        new = np.append(True, (key[1:] != key[:-1]) | (name[1:] != name[:-1]))[: len(key)]
        back = np.empty(len(order), np.int64)
        back[order] = np.cumsum(new) - 1
        place = back[place]
        return at, place, key[new], name[new], _least(self.doc[at], place, int(new.sum()))

    def ask_spans(self):
        _, _, key, name, doc = self.spans(self.parsed.span_classes)
        for bucket, low, high in self.cuts(key, KEY_BITS):
            yield bucket, _narrow(key[low:high]), name[low:high].tobytes(), _zip(doc[low:high])

    def settled(self):
        """(stretches to remove, stretches whose windows are asked for one by one)."""
        at, place, key, _, doc = self.spans()
        smaller, still_open = self.answer(1, self.cuts(key, KEY_BITS), len(key))
        gone = smaller[place] | (self.doc[at] > doc[place])
        return at[gone], at[still_open[place]]

    # Step 3: windows.
    def windows(self, stretches: np.ndarray, compare=None):
        """Window starts of stretches, their places among the different windows, and of those name
        and smallest document, in the order of names. ``compare`` is as for spans."""
        length = self.length[stretches]
        start = np.repeat(self.start[stretches], length) + (
            np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        )
        doc = np.repeat(self.doc[stretches], length)
        place, first = _classes(compare, start)
        name, back = np.unique(self.parsed.window_names(start[first]), return_inverse=True)
        place = back[place]
        return start, doc, place, name, _least(doc, place, len(name))

    def ask_windows(self, stretches: np.ndarray):
        _, _, _, name, doc = self.windows(stretches, self.parsed.window_classes)
        for bucket, low, high in self.cuts(name, 64 - self.bucket_bits):
            yield bucket, name[low:high].tobytes(), b"", _zip(doc[low:high])

    def repeated_windows(self, stretches: np.ndarray, step: int) -> np.ndarray:
        start, doc, place, name, least = self.windows(stretches)
        smaller, _ = self.answer(step, self.cuts(name, 64 - self.bucket_bits), len(name))
        return start[smaller[place] | (doc > least[place])]


def _classes(compare, start: np.ndarray, *rest) -> tuple[np.ndarray, np.ndarray]:
    """Class of each string, numbered from 0 without gaps, and the first string of each class."""
    if compare is None or not len(start):
        return np.arange(len(start)), np.arange(len(start))
    place = compare(start, *rest)
    first = np.empty(place.max() + 1, np.int64)
    first[place[::-1]] = np.arange(len(place) - 1, -1, -1)
    return place, first


def _least(doc: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, place, doc)
    return least


def _shards(batches, finder, bucket_bits: int, steps: int):
    for batch in batches:
        for row in range(batch.num_rows):
            cell = {name: batch.column(k)[row] for k, name in enumerate(batch.schema.names)}
            ids = [NULL_ID if i is None else i for i in cell["ids"].as_py()]
            yield Shard(
                cell["shard"].as_py(),
                np.array(ids, np.int64),
                _unzip(cell["text"].as_py(), np.uint8),
                _unzip(cell["offsets"].as_py(), np.int64),
                finder,
                bucket_bits,
                [cell[f"answers_{k}"].as_py() for k in range(steps)],
            )


def _asker(finder, bucket_bits: int, steps: int, ask):
    def run(batches):
        for shard in _shards(batches, finder, bucket_bits, steps):
            rows = [(bucket, shard.number, *blobs) for bucket, *blobs in ask(shard)]
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["bucket", "shard", "names", "extra", "docs"],
            )
            # The next shard is built when this one is gone.
            del shard

    return run


def _answer_table(shards, bucket: int, bits: list[bytes], still_open: list[bytes]) -> pa.Table:
    return pa.table(
        {
            "shard": pa.array(shards, pa.int64()),
            "bucket": pa.array([bucket] * len(shards), pa.int32()),
            "bits": pa.array(bits, pa.binary()),
            "open": pa.array(still_open, pa.binary()),
        }
    )


def _questions(table: pa.Table):
    blobs = [[cell.as_buffer() for cell in table.column(c)] for c in ("names", "extra", "docs")]
    return [table.column("shard").to_pylist(), *blobs], table.column("bucket")[0].as_py()


def _answer_keys(table: pa.Table) -> pa.Table:
    """Keys of several shards, or of several documents of one."""
    (shards, names, several, _), bucket = _questions(table)
    keys = [_wide(b) for b in names]
    merged = np.sort(np.concatenate(keys))
    inside = [k[_flags(f, len(k))] for k, f in zip(keys, several)]
    repeated = np.unique(np.concatenate([merged[1:][merged[1:] == merged[:-1]], *inside]))
    bits = []
    for k in keys:
        at = np.searchsorted(repeated, k)
        at[at == len(repeated)] = 0
        bits.append(_bits(repeated[at] == k if len(repeated) else np.zeros(len(k), bool)))
    return _answer_table(shards, bucket, bits, [b""] * len(bits))


def _answer_spans(table: pa.Table) -> pa.Table:
    """Whether the span is in a smaller document, and whether windows of its key are asked for."""
    (shards, names, extra, docs), bucket = _questions(table)
    keys = [_wide(b) for b in names]
    sizes = [len(k) for k in keys]
    key = np.concatenate(keys)
    span = np.concatenate([np.frombuffer(b, np.uint64) for b in extra])
    doc = np.concatenate([_unzip(b, np.int64) for b in docs])
    order = np.lexsort((span, key))
    k, s, d = key[order], span[order], doc[order]
    new_key = np.append(True, k[1:] != k[:-1])
    new_span = new_key | np.append(True, s[1:] != s[:-1])
    of_key, of_span = np.cumsum(new_key) - 1, np.cumsum(new_span) - 1
    least_key = np.minimum.reduceat(d, np.flatnonzero(new_key))
    least_span = np.minimum.reduceat(d, np.flatnonzero(new_span))
    smaller = least_span[of_span] < d
    left = ~smaller & (least_key[of_key] < d)
    any_left = np.zeros(len(least_key), bool)
    any_left[of_key[left]] = True
    out = np.empty((2, len(order)), bool)
    out[0, order], out[1, order] = smaller, any_left[of_key]
    at = np.cumsum([0, *sizes])
    parts = [[_bits(x[a:b]) for a, b in zip(at[:-1], at[1:])] for x in out]
    return _answer_table(shards, bucket, *parts)


def _answer_windows(table: pa.Table) -> pa.Table:
    """Whether the window starts in a smaller document of another shard."""
    (shards, names, _, docs), bucket = _questions(table)
    parts = [np.frombuffer(b, np.uint64) for b in names]
    at = np.cumsum([0, *map(len, parts)])
    name = np.concatenate(parts)
    # Arrays of a bucket are many times a shard's: each goes as soon as it is used.
    del names, parts
    order = np.argsort(name)
    name = name[order]
    new = np.append(True, name[1:] != name[:-1])
    del name
    doc = np.empty(len(order), np.int64)
    for blob, low, high in zip(docs, at[:-1], at[1:]):
        doc[low:high] = _unzip(blob, np.int64)
    doc = doc[order]
    least = np.minimum.reduceat(doc, np.flatnonzero(new))
    smaller = np.empty(len(order), bool)
    smaller[order] = least[np.cumsum(new) - 1] < doc
    bits = [_bits(smaller[low:high]) for low, high in zip(at[:-1], at[1:])]
    return _answer_table(shards, bucket, bits, [b""] * len(bits))


def _finisher(finder, bucket_bits: int, steps: int, removed):
    def run(batches):
        for shard in _shards(batches, finder, bucket_bits, steps):
            rows = shard.parsed.results(removed(shard))
            ids = [None if i == NULL_ID else i for i in shard.ids.tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *rows], names=["doc_id", "n_units", "removed", "kept"]
            )
            del shard

    return run


RESULT = (
    "doc_id bigint, n_units bigint, removed array<struct<start: bigint, length: bigint>>, kept binary"
)


def remove_repeats(docs: DataFrame, finder, by_spans: bool, folder: str | None = None) -> DataFrame:
    """(doc_id, n_units, removed, kept) of every row: units in the text, the runs of units that a
    window covers which also starts in a smaller document, and the bytes that stay."""
    spark = docs.sparkSession
    folder = folder or work_folder(spark)
    packed = docs.select("doc_id", "text").mapInArrow(_pack, SHARDS)
    n_parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    name = f"corpus_{uuid.uuid4().hex}"
    (
        packed.repartition(n_parts, "shard")
        .write.bucketBy(n_parts, "shard")
        .option("path", f"{folder}/shards")
        .saveAsTable(name)
    )
    shards = spark.table(name)
    n_bytes = shards.agg(F.sum("n_bytes")).first()[0] or 0
    bucket_bits = min(20, max(0, (n_bytes // BUCKET_BYTES).bit_length()))

    def with_answers(answers: list[DataFrame]) -> DataFrame:
        out = shards
        for k, a in enumerate(answers):
            grouped = a.groupBy("shard").agg(
                F.collect_list(F.struct("bucket", "bits", "open")).alias(f"answers_{k}")
            )
            out = out.join(grouped, "shard", "left")
        return out.select("shard", "ids", "offsets", "text", *(f"answers_{k}" for k in range(len(answers))))

    def step(answers: list[DataFrame], ask, answer) -> DataFrame:
        k = len(answers)
        asked = with_answers(answers).mapInArrow(_asker(finder, bucket_bits, k, ask), ASKED)
        return stored(asked.groupBy("bucket").applyInArrow(answer, ANSWERED), f"{folder}/answers-{k}")

    answers = [step([], Shard.ask_keys, _answer_keys)]
    if by_spans:
        answers.append(step(answers, Shard.ask_spans, _answer_spans))
        answers.append(step(answers, lambda s: s.ask_windows(s.settled()[1]), _answer_windows))

        def removed(shard: Shard):
            gone, single = shard.settled()
            starts = shard.repeated_windows(single, 2)
            return [(shard.start[gone], shard.length[gone]), (starts, np.ones_like(starts))]

    else:
        answers.append(step(answers, lambda s: s.ask_windows(s.repeated()), _answer_windows))

        def removed(shard: Shard):
            starts = shard.repeated_windows(shard.repeated(), 1)
            return [(starts, np.ones_like(starts))]

    return with_answers(answers).mapInArrow(
        _finisher(finder, bucket_bits, len(answers), removed), RESULT
    )


def covered_runs(n: int, bounds: np.ndarray, removed, width: int):
    """Which of ``n`` units the removed windows cover, and the runs of them per text.

    ``removed`` holds (first windows, numbers of windows); ``bounds`` are the units where texts
    start and, last, ``n``.
    """
    change = np.zeros(n + 1, np.int32)
    for start, length in removed:
        np.add.at(change, start, 1)
        np.add.at(change, start + length - 1 + width, -1)
    gone = np.cumsum(change[:-1], dtype=np.int32) > 0
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    first = gone & np.append(True, ~gone[:-1])[:n] | gone & edge[:n]
    starts = np.flatnonzero(first)
    last = gone & (np.append(~gone[1:], True)[:n] | edge[1:])
    ends = np.flatnonzero(last) + 1
    text = np.searchsorted(bounds, starts, "right") - 1
    per_text = np.bincount(text, minlength=len(bounds) - 1)
    runs = pa.StructArray.from_arrays(
        [pa.array(starts - bounds[text], pa.int64()), pa.array(ends - starts, pa.int64())],
        names=["start", "length"],
    )
    at = np.append(0, np.cumsum(per_text)).astype(np.int32)
    return gone, pa.ListArray.from_arrays(pa.array(at, pa.int32()), runs)
