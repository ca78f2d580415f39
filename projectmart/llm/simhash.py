"""SimHash near-dedup with keys from the binary Golay code.

A fingerprint has 64 bits: segments A and B of 23 bits and C of 18. The perfect Golay code of
length 23 has a codeword within three bits of any word. The keys of a segment are the codewords
within four bits of it (one or six of them): two segments that differ in one bit at most always
share the codeword nearest to either, since four bits reach one bit further than three.

Links differ in three bits at most, so by the pigeonhole principle
- either some segment is equal and another differs in one bit at most: keys of an equal segment and
  a codeword of another;
- or each segment differs in exactly one bit: keys of a codeword of A, an equal half of B and an
  equal half of C.
A key so has 30 bits or more besides the number of its kind. Only different fingerprints are keyed,
so copies never meet. Rows are sorted by key; within a key, near fingerprints are found by comparing
neighbours, or, for many, by growing groups from a fingerprint over those that are not reached yet.
Each key then gives links that join its groups, never all pairs, and no link between groups is lost.

Defined results: null and empty texts have fingerprint zero and are linked like any other. A null
document id never is the smallest, unless a component has no other. Repeated rows are linked by
their equal fingerprints. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from projectmart.llm.components import connected
from projectmart.llm.rows import id_order, kept_rows, row_key
from projectmart.llm.storage import stored, work_folder

SHINGLE = 3
MAX_BITS = 3
SEED = 42
GENERATOR = 0b101011100011
# Up to this many fingerprints of a key are compared with their neighbours; more grow groups.
SMALL_RUN = 12
# Longer runs are split before groups grow.
LONG_RUN = 1024
CHUNK = 1 << 15


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of some unsigned 64-bit hashes; zero if there are none."""
    ones = np.zeros(64, np.int64)
    for low in range(0, len(hashes), CHUNK):
        part = hashes[low : low + CHUNK].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """The SimHash of the shingles of a text, lower-cased in A-Z, as unsigned 64 bits."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(width)))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], np.uint64)
    return majority(hashes)


def _fingerprints(width: int):
    def run(batches):
        for batch in batches:
            texts = pc.fill_null(batch.column(1).cast(pa.large_binary()), b"")
            # One text at a time: a batch of long texts need not be in memory twice.
            values = [fingerprint(t.as_py(), width) for t in texts]
            out = np.array(values, np.uint64).view(np.int64)
            more = batch.columns[2:]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(out), *more],
                names=["doc_id", "fingerprint", *batch.schema.names[2:]],
            )

    return run


class Golay:
    """Codewords within four bits of any 23-bit word, by syndrome."""

    def __init__(self):
        low = np.arange(1 << 12, dtype=np.int64)
        self._low = self._remainder(low)
        self._high = self._remainder(low[: 1 << 11] << 12)
        bits = 1 << np.arange(23, dtype=np.int64)
        errors = [np.zeros(1, np.int64)]
        for _ in range(4):
            grown = np.unique((errors[-1][:, None] | bits[None, :]).ravel())
            errors.append(grown[~np.isin(grown, errors[-1])])
        by_syndrome: list[list[int]] = [[] for _ in range(1 << 11)]
        for e in np.concatenate(errors).tolist():
            by_syndrome[int(self.syndrome(np.array([e]))[0])].append(e)
        self.count = np.array([len(x) for x in by_syndrome])
        self.errors = np.array([x + x[:1] * (6 - len(x)) for x in by_syndrome], np.int64)

    @staticmethod
    def _remainder(x: np.ndarray) -> np.ndarray:
        x = x.copy()
        for bit in range(22, 10, -1):
            x = np.where((x >> bit) & 1, x ^ (GENERATOR << (bit - 11)), x)
        return x

    def syndrome(self, x: np.ndarray) -> np.ndarray:
        return self._low[x & 0xFFF] ^ self._high[x >> 12]

    def indices(self, x: np.ndarray) -> np.ndarray:
        """Six codeword indices of each word; where only one is near, it stands six times."""
        return (x[:, None] ^ self.errors[self.syndrome(x)]) >> 11


def golay_keys(prints: np.ndarray, golay: Golay) -> tuple[np.ndarray, np.ndarray]:
    """(keys, fingerprints): all keys of each fingerprint, kinds in the upper bits."""
    x = prints.view(np.uint64)
    a = (x & np.uint64(0x7FFFFF)).astype(np.int64)
    b = ((x >> np.uint64(23)) & np.uint64(0x7FFFFF)).astype(np.int64)
    c = (x >> np.uint64(46)).astype(np.int64)
    near = {n: golay.indices(s) for n, s in (("a", a), ("b", b), ("c", c))}
    kinds = [(c, "a"), (c, "b"), (b, "a"), (b, "c"), (a, "b"), (a, "c")]
    for half_b in (b & 0xFFF, b >> 12):
        for half_c in (c & 0x1FF, c >> 9):
            kinds.append(((half_b << 9) | half_c, "a"))
    keys, owners = [], []
    for kind, (exact, code) in enumerate(kinds):
        key = (np.int64(kind) << 40) | (exact[:, None] << 12) | near[code]
        new = np.ones(key.shape, bool)
        # A word near a single codeword has one key, not six equal ones.
        new[:, 1:] = key[:, 1:] != key[:, :1]
        keys.append(key[new])
        owners.append(np.broadcast_to(prints[:, None], key.shape)[new])
    return np.concatenate(keys), np.concatenate(owners)


def _keyed(batches):
    golay = Golay()
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False)
        for low in range(0, len(prints), CHUNK):
            keys, owners = golay_keys(np.ascontiguousarray(prints[low : low + CHUNK]), golay)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(owners)], names=["key", "fingerprint"]
            )


def _near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count((x ^ y).view(np.uint64)) <= MAX_BITS


def grown_links(prints: np.ndarray) -> list[tuple[int, int]]:
    """Links that join all fingerprints within three bits, straight or over others of the run.

    In long runs the bits that vary are dealt into one part more than the bits that may differ: two
    near fingerprints agree in some part, so those that agree in a part are looked at by themselves.
    """
    links: list[tuple[int, int]] = []
    todo = [np.unique(prints)]
    while todo:
        run = todo.pop()
        if len(run) <= LONG_RUN:
            links.extend(_grown(run))
            continue
        values = run.view(np.uint64)
        varying = int(np.bitwise_or.reduce(values ^ values[0]))
        places = [b for b in range(64) if varying >> b & 1]
        for part in range(MAX_BITS + 1):
            same = values & np.uint64(sum(1 << b for b in places[part :: MAX_BITS + 1]))
            order = np.argsort(same, kind="stable")
            cuts = np.flatnonzero(np.diff(same[order])) + 1
            todo.extend(x for x in np.split(run[order], cuts) if len(x) > 1)
    return links


def _grown(prints: np.ndarray) -> list[tuple[int, int]]:
    """Links of a run that is not split.

    A group grows from its first fingerprint over those not reached yet; in a dense run few are
    left after the first step, so that the work is far from that of all pairs.
    """
    links, rest = [], np.unique(prints)
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        frontier = np.array([root])
        while len(frontier) and len(rest):
            grown = np.zeros(len(rest), bool)
            step = max(1, (1 << 20) // len(rest))
            for low in range(0, len(frontier), step):
                part = frontier[low : low + step]
                grown |= _near(part[:, None], rest[None, :]).any(axis=0)
            frontier, rest = rest[grown], rest[~grown]
            links.extend((int(root), int(f)) for f in frontier)
    return links


def _linked(batches):
    """Links within runs of equal keys; rows come sorted by key."""

    def links_of(key, prints):
        edges = [np.zeros((0, 2), np.int64)]
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        lengths = np.diff(np.append(starts, len(key)))
        size = np.repeat(lengths, lengths)
        for step in range(1, SMALL_RUN):
            pair = (size[:-step] <= SMALL_RUN) & (key[:-step] == key[step:])
            at = np.flatnonzero(pair)
            if not len(at):
                break
            at = at[_near(prints[at], prints[at + step])]
            edges.append(np.stack([prints[at], prints[at + step]], axis=1))
        for k in np.flatnonzero(lengths > SMALL_RUN):
            found = grown_links(prints[starts[k] : starts[k] + lengths[k]])
            edges.append(np.array(found, np.int64).reshape(-1, 2))
        edges = np.concatenate(edges)
        edges = edges[edges[:, 0] != edges[:, 1]]
        return np.unique(np.sort(edges, axis=1), axis=0)

    held: list[tuple[np.ndarray, np.ndarray]] = []

    def out(key, prints):
        edges = links_of(key, prints)
        return pa.RecordBatch.from_arrays(
            [pa.array(edges[:, 0].copy()), pa.array(edges[:, 1].copy())], names=["a", "b"]
        )

    for batch in batches:
        key = batch.column(0).to_numpy(zero_copy_only=False)
        prints = batch.column(1).to_numpy(zero_copy_only=False)
        if not len(key):
            continue
        if held and held[-1][0][-1] == key[-1]:
            held.append((key, prints))
            continue
        # The last key may go on in the next batch.
        cut = int(np.searchsorted(key, key[-1]))
        held.append((key[:cut], prints[:cut]))
        done = [np.concatenate(x) for x in zip(*held)]
        if len(done[0]):
            yield out(*done)
        held = [(key[cut:], prints[cut:])]
    if held:
        yield out(*(np.concatenate(x) for x in zip(*held)))


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint as signed 64 bits) of every row."""
    return docs.select("doc_id", "text").mapInArrow(
        _fingerprints(width), "doc_id bigint, fingerprint bigint"
    )


def links(prints: DataFrame) -> DataFrame:
    """Links (a, b) that join all of the different ``prints`` within three bits."""
    keyed = prints.select("fingerprint").mapInArrow(_keyed, "key bigint, fingerprint bigint")
    in_order = keyed.repartition("key").sortWithinPartitions("key", "fingerprint")
    return in_order.mapInArrow(_linked, "a bigint, b bigint").distinct()


def with_roots(different: DataFrame, folder: str) -> DataFrame:
    """``different`` (fingerprint, ...) with the root of each component."""
    roots = connected(links(different), f"{folder}/components")
    return different.join(
        roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left"
    ).withColumn("root", F.coalesce("root", "fingerprint"))


def near_duplicates(
    docs: DataFrame, width: int = SHINGLE, folder: str | None = None
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; the component is named by its smallest id."""
    folder = folder or work_folder(docs.sparkSession)
    rows = stored(fingerprints(docs, width), f"{folder}/fingerprints")
    different = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first_doc"))
    of_root = with_roots(stored(different, f"{folder}/different"), folder)
    # The smallest document of each component: only linked fingerprints need a second look.
    smallest = of_root.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    named = of_root.join(smallest, "root").select("fingerprint", "component_id")
    return rows.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def one_of_each(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """The smallest row of each component, with the columns of ``docs``.

    A row without an id never is the smallest, unless a component has no other. Rows that share an
    id but not the text are rows of their own.
    """
    folder = work_folder(docs.sparkSession)
    rows = docs.select("doc_id", "text", row_key().alias("row")).mapInArrow(
        _fingerprints(width), "doc_id bigint, fingerprint bigint, row string"
    )
    first = rows.groupBy("fingerprint").agg(F.min(id_order()).alias("first"))
    of_root = with_roots(stored(first, f"{folder}/different"), folder)
    return kept_rows(docs, of_root.groupBy("root").agg(F.min("first").alias("first")))
