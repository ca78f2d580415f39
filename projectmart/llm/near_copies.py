"""Near copies by shingle similarity: sets of five words, Jaccard similarity of 0.8 or more.

SimHash comes first: a text's fingerprint of 64 bits is the majority of the hashes of its set, and keys of
the Golay code (``simhash``) find fingerprints within three bits. Texts of such fingerprints are verified
on the shingles themselves and linked. That finds the nearest copies, but texts of similarity 0.8 differ
in ten bits on average, and no number of bits is sure; so keys of shingles find what is left.

Every pair is found, and no other. Two sets of that similarity share one of their first
n - ceil(0.8 n) + 1 shingles in any order that holds for all texts; here, shingles that a sample finds
in many texts come last, and the rest follow their hash. Those shingles are the keys. Texts of one
key are candidates if their sizes allow the similarity and if their parity bits do: the bits in which
two texts differ are never more than the shingles in which they differ. What is left is verified on
the shingles themselves, and only verified pairs link texts.

A text that has its first common key at place i of n shares at most n - i shingles with any other,
and similar texts share 4/9 of all their shingles: pairs whose places leave fewer are never made.
Texts that share boilerplate of less than the similarity have their own shingles first, so they do not
even meet. The smaller text of a pair has the key among its first ninth; only such texts open a key.

Keys of few texts give all their pairs. In keys of many texts, some rounds compare all texts with one
of them: first with the one that has the fewest shingles of its own before the key, since the others
are most often copies of that one. Then only pairs that are not linked yet, straight or over others,
are compared, by neighbouring sizes; the join itself holds their parity bits against each other.

Defined results: null and texts without words are equal to each other and similar to no other; a
text of fewer than five words is one shingle. Repeated rows are one text. A null document id is never
the smallest, unless a group has no other. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from projectmart.llm import simhash
from projectmart.llm.arrays import binary
from projectmart.llm.components import connected
from projectmart.llm.rows import id_order, kept_rows, row_key
from projectmart.llm.storage import removed, stored, work_folder
from projectmart.operators.joins import enrich_hot

SHINGLE = 5
SEED = 42
# Jaccard similarity as a fraction, so that it is compared without rounding.
ABOVE, BELOW = 4, 5
# Keys of more texts are not compared pair by pair.
SMALL_KEY = 32
# Rounds that compare a key's texts with one of them.
STARS = 2
# Words of 64 parity bits that the last join compares.
PARITY_WORDS = 4
# One text of so many is looked through for common shingles; the order of keys follows from them,
# the result does not.
SAMPLED, COMMON, MOST_COMMON = 16, 8, 500_000


def shingles(text: bytes) -> np.ndarray:
    """The sorted, different hashes of the shingles of a text, lower-cased in A-Z."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < SHINGLE:
        runs = [b" ".join(words)]
    else:
        runs = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE))))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(s, SEED) for s in runs), np.uint64))


def prefix(found: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The shingles of which similar texts share one; those of ``common`` (sorted) come last."""
    n = len(found)
    if not n:
        return found
    if len(common):
        at = np.minimum(np.searchsorted(common, found), len(common) - 1)
        often = common[at] == found
        found = np.concatenate([found[~often], found[often]])
    return found[: n - -(-ABOVE * n // BELOW) + 1]


def parity(found: np.ndarray) -> bytes:
    """One bit for each slot of shingle hashes: whether their number is odd."""
    size = 1 << max(6, int(len(found)).bit_length())
    odd = np.bincount((found & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def may_be_similar(n: int, bits: bytes, m: int, others: bytes) -> bool:
    """False only if two texts of so many shingles differ in too many of them."""
    x, y = np.frombuffer(bits, np.uint8), np.frombuffer(others, np.uint8)
    while len(x) != len(y):
        # Halves of a longer table fold into one: slots are the low bits of the hash.
        if len(x) > len(y):
            x = x[: len(x) // 2] ^ x[len(x) // 2 :]
        else:
            y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    differ = int(np.bitwise_count(x ^ y).sum())
    return (ABOVE + BELOW) * differ <= (BELOW - ABOVE) * (n + m)


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return BELOW * both >= ABOVE * (len(x) + len(y) - both)


def _texts(batch):
    return (t.as_py() for t in binary(batch.column(batch.schema.get_field_index("text"))))


def _distinct_shingles(batches):
    for batch in batches:
        for text in _texts(batch):
            found = pa.array(shingles(text).view(np.int64))
            yield pa.RecordBatch.from_arrays([found], names=["shingle"])


def common_shingles(docs: DataFrame) -> np.ndarray:
    """Shingles of many texts of a sample, sorted: at most ``MOST_COMMON``."""
    drawn = docs.select("text").filter(F.pmod(F.xxhash64("text"), F.lit(SAMPLED)) == 0)
    counts = drawn.mapInArrow(_distinct_shingles, "shingle bigint").groupBy("shingle").count()
    often = counts.filter(F.col("count") >= COMMON).orderBy(F.desc("count")).limit(MOST_COMMON)
    found = [r["shingle"] for r in often.select("shingle").collect()]
    return np.sort(np.array(found, np.int64).view(np.uint64))


def _sketches(common):
    def run(batches):
        order = common.value
        for batch in batches:
            names, prints, sizes, bits, keys = [], [], [], [], []
            for text in _texts(batch):
                found = shingles(text)
                names.append(xxhash.xxh64_intdigest(found.tobytes(), SEED))
                prints.append(simhash.majority(found))
                sizes.append(len(found))
                bits.append(parity(found))
                keys.append(prefix(found, order).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    batch.column(1),
                    pa.array(np.array(names, np.uint64).view(np.int64)),
                    pa.array(np.array(prints, np.uint64).view(np.int64)),
                    pa.array(sizes, pa.int64()),
                    pa.array(bits, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["doc_id", "row", "name", "fingerprint", "n", "bits", "keys"],
            )

    return run


def room(n, place, m, other) -> np.ndarray:
    """Whether texts whose first common key is at these places may share enough shingles."""
    return (ABOVE + BELOW) * np.minimum(n - place, m - other) >= ABOVE * (n + m)


def _met(batches):
    """Pairs (a, b) of keys of few texts; (a, n, place, key) of keys of many. Rows come sorted by key
    and n; no more than the rows of a batch and ``SMALL_KEY`` more are held."""
    empty = np.zeros(0, np.int64)

    def out(rows, forced):
        key, n, place, name = rows
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        lengths = np.diff(np.append(starts, len(key)))
        size = np.repeat(lengths, lengths)
        few, a, b = (size <= SMALL_KEY) & ~forced, [], []
        for step in range(1, SMALL_KEY):
            at = np.flatnonzero(few[:-step] & few[step:] & (key[:-step] == key[step:]))
            if not len(at):
                break
            at = at[BELOW * n[at] >= ABOVE * n[at + step]]
            at = at[room(n[at], place[at], n[at + step], place[at + step])]
            a.append(np.minimum(name[at], name[at + step]))
            b.append(np.maximum(name[at], name[at + step]))
        many = ~few
        pairs, rest = sum(map(len, a)), int(many.sum())
        nothing = pa.nulls(pairs, pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([*a, name[many]])),
                pa.concat_arrays([pa.array(np.concatenate([empty, *b])), pa.nulls(rest, pa.int64())]),
                *(pa.concat_arrays([nothing, pa.array(x[many])]) for x in (n, place, key)),
            ],
            names=["a", "b", "n", "place", "key"],
        )

    held, open_key = [empty] * 4, None
    for batch in batches:
        rows = [np.concatenate([h, batch.column(i).to_numpy(zero_copy_only=False)]) for i, h in enumerate(held)]
        key = rows[0]
        if not len(key):
            continue
        forced = np.zeros(len(key), bool)
        # A key that was too long for the batch before is a key of many.
        if open_key is not None:
            forced[: np.searchsorted(key, open_key, "right")] = True
        last = int(np.searchsorted(key, key[-1]))
        long = len(key) - last > SMALL_KEY or (open_key is not None and key[-1] == open_key)
        if long:
            forced[last:] = True
            held, open_key = [empty] * 4, key[-1]
            yield out(rows, forced)
        else:
            held, open_key = [x[last:] for x in rows], None
            if last:
                yield out([x[:last] for x in rows], forced[:last])
    if len(held[0]):
        yield out(held, np.zeros(len(held[0]), bool))


def _possible(batches):
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("n_a", "bits_a", "n_b", "bits_b")))
        yield batch.filter(pa.array([may_be_similar(*r) for r in rows], pa.bool_())).select(["a", "b"])


def _verified(batches):
    for batch in batches:
        rows = zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist())
        good = [similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in rows]
        yield batch.filter(pa.array(good, pa.bool_())).select(["a", "b"])


def _sets(batches):
    for batch in batches:
        found = pa.array([shingles(t).tobytes() for t in _texts(batch)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["name", "set"])


def _parity_words(batches):
    slots = 64 * PARITY_WORDS
    for batch in batches:
        words = np.zeros((batch.num_rows, PARITY_WORDS), np.uint64)
        for k, found in enumerate(batch.column("set")):
            low = np.frombuffer(found.as_py(), np.uint64) & np.uint64(slots - 1)
            odd = np.bincount(low.astype(np.int64), minlength=slots) & 1
            words[k] = np.packbits(odd.astype(np.uint8)).view(np.uint64)
        columns = [pa.array(np.ascontiguousarray(w).view(np.int64)) for w in words.T]
        names = ["a", *(f"p{i}" for i in range(PARITY_WORDS))]
        yield pa.RecordBatch.from_arrays([batch.column("name"), *columns], names=names)


def parity_words(sets: DataFrame) -> DataFrame:
    """(a, p0, p1, ...): the parity bits of each text in as many words, whatever its length."""
    fields = ", ".join(f"p{i} bigint" for i in range(PARITY_WORDS))
    return sets.mapInArrow(_parity_words, f"a bigint, {fields}")


def with_both(pairs: DataFrame, table: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with the columns of ``table`` (name, ...) of either side."""
    for side in ("a", "b"):
        named = {c: f"{c}_{side}" for c in table.columns if c != "name"}
        pairs = pairs.join(table.withColumnsRenamed({**named, "name": side}), side)
    return pairs


def simhash_pairs(different: DataFrame, folder: str) -> DataFrame:
    """Pairs (a, b) of different texts (name, fingerprint) that SimHash finds: each text with one of its
    fingerprint, and those of fingerprints that are linked."""
    one = different.groupBy("fingerprint").agg(F.min("name").alias("one"), F.count("*").alias("texts"))
    ones = stored(one, f"{folder}/fingerprints")
    equal = different.join(ones.filter("texts > 1"), "fingerprint").filter("name <> one")
    linked = simhash.links(ones)
    for side in ("a", "b"):
        named = ones.select(F.col("fingerprint").alias(side), F.col("one").alias(f"one_{side}"))
        linked = linked.join(named, side)
    pairs = equal.select(F.col("one").alias("a"), F.col("name").alias("b")).union(
        linked.select(F.least("one_a", "one_b"), F.greatest("one_a", "one_b"))
    )
    return stored(pairs, f"{folder}/near")


def possible(pairs: DataFrame, different: DataFrame) -> DataFrame:
    sized = with_both(pairs.distinct(), different.select("name", "n", "bits"))
    return sized.mapInArrow(_possible, "a bigint, b bigint")


def cross_pairs(many: DataFrame, roots: DataFrame, star: int | None) -> DataFrame:
    """Pairs of texts of one key, sized alike, in different groups: with one text of each key, or all
    (``many`` then has the parity words, too).

    The smaller text of a pair has the key among its first ninth, so a key without such a text has no
    pairs, and all pairs are those of such texts with the others. Sizes lie in bands, each wider than
    the ratio of similar sizes, so that only texts of the same or the next band meet.
    """
    of = roots.withColumnRenamed("node", "a")
    named = many.join(of, "a", "left").withColumn("root", F.coalesce("root", "a"))
    first = (ABOVE + BELOW) * (F.col("n") - F.col("place")) >= 2 * ABOVE * F.col("n")
    # The text with the fewest shingles of its own before the key, then any: in either round, one text is
    # the first in most of its keys, so that most keys give the same pairs.
    own = F.lit(0) if star else F.col("place")
    order = [own.alias("own"), F.xxhash64(F.lit(star or 0), "a").alias("h")]
    one = F.min(F.struct(*order, "a", "n", "place", "root"))
    parted = named.groupBy("key").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.bool_or(first).alias("opened"), one.alias("one")
    )
    # With one text, places do not matter: a pair that has none left at this key may have met at another,
    # and the more it links, the fewer pairs the last round makes.
    parted = parted.filter("lo <> hi" if star is not None else "lo <> hi AND opened")
    named = enrich_hot(named, parted, "key", ["one"]).filter("one IS NOT NULL")
    others = {"a": "b", "n": "m", "place": "other_place", "root": "other"}
    if star is not None:
        met = named.select(*others, *(F.col(f"one.{c}").alias(name) for c, name in others.items()))
    else:
        others |= {f"p{i}": f"q{i}" for i in range(PARITY_WORDS)}
        band = F.floor(F.log("n") / F.log(F.lit(1.01 * BELOW / ABOVE))).cast("int")
        opening = named.filter(first).select(
            F.xxhash64("key", band).alias("meet"), *(F.col(c).alias(name) for c, name in others.items())
        )
        bands = named.select("key", *others, F.explode(F.array(band - 1, band)).alias("band"))
        met = enrich_hot(
            bands.select(F.xxhash64("key", "band").alias("meet"), *others), opening, "meet", [*others.values()]
        )
    alike = (BELOW * F.least("n", "m") >= ABOVE * F.greatest("n", "m")) & (F.col("root") != F.col("other"))
    if star is None:
        shared = F.least(F.col("n") - F.col("place"), F.col("m") - F.col("other_place"))
        alike &= (ABOVE + BELOW) * shared >= ABOVE * (F.col("n") + F.col("m"))
        differ = [F.bit_count(F.col(f"p{i}").bitwiseXOR(F.col(f"q{i}"))) for i in range(PARITY_WORDS)]
        alike &= (ABOVE + BELOW) * sum(differ) <= (BELOW - ABOVE) * (F.col("n") + F.col("m"))
    pairs = met.filter(alike)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_copies(docs: DataFrame, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Different texts (name, first: id and row key of the smallest row), and (node, root) of those
    that are linked."""
    spark = docs.sparkSession
    folder, context = folder or work_folder(spark), spark.sparkContext
    keyed = docs.select("doc_id", row_key().alias("row"), "text")
    common = context.broadcast(common_shingles(docs))
    rows = keyed.mapInArrow(
        _sketches(common),
        "doc_id bigint, row string, name bigint, fingerprint bigint, n bigint, bits binary, keys array<bigint>",
    )
    firsts = [F.first(c).alias(c) for c in ("fingerprint", "n", "bits", "keys")]
    keyed_texts = stored(
        rows.groupBy("name").agg(F.min(id_order()).alias("first"), *firsts), f"{folder}/keyed"
    )
    different = stored(keyed_texts.drop("keys"), f"{folder}/different")
    in_order = (
        keyed_texts.select(F.posexplode("keys").alias("place", "key"), "n", "name")
        .select("key", "n", F.col("place").cast("bigint"), "name")
        .repartition("key")
        .sortWithinPartitions("key", "n")
    )
    near = simhash_pairs(different, folder)
    met = in_order.mapInArrow(_met, "a bigint, b bigint, n bigint, place bigint, key bigint")
    met = stored(met, f"{folder}/met")
    removed(spark, f"{folder}/keyed")
    # What SimHash found is verified already.
    few = met.filter("b IS NOT NULL").select("a", "b").join(near, ["a", "b"], "left_anti")
    few = possible(few, different)
    few = stored(few, f"{folder}/few")
    many = met.filter("b IS NULL").select("a", "n", "place", "key")

    ends = near.union(few)
    needed = ends.select(F.col("a").alias("name")).union(ends.select("b")).union(many.select("a")).distinct()
    wanted = different.join(needed, "name", "left_semi").select("name", F.col("first.row").alias("row"))
    texts = keyed.drop("doc_id").join(wanted, "row").dropDuplicates(["name"]).select("name", "text")
    sets = stored(texts.mapInArrow(_sets, "name bigint, set binary"), f"{folder}/sets")

    def verified(pairs: DataFrame) -> DataFrame:
        return with_both(pairs, sets).mapInArrow(_verified, "a bigint, b bigint")

    links = stored(verified(near), f"{folder}/verified-near")
    links = links.union(stored(verified(few), f"{folder}/verified"))
    scratch = ["fingerprints", "near", "met", "few", "sets", "verified-near", "verified"]
    roots = settled(links, folder, "components")
    if not many.isEmpty():
        for k, star in enumerate([*range(STARS), None]):
            if star is None:
                many = stored(many.join(parity_words(sets), "a"), f"{folder}/worded")
                scratch.append("worded")
            pairs = stored(possible(cross_pairs(many, roots, star), different), f"{folder}/possible-{k}")
            scratch.append(f"possible-{k}")
            if pairs.isEmpty():
                continue
            links = links.union(stored(verified(pairs), f"{folder}/verified-{k}"))
            scratch.append(f"verified-{k}")
            roots = settled(links, folder, f"components-{k}")
    # The result reads the different texts and the roots, nothing else.
    removed(spark, *(f"{folder}/{name}" for name in scratch))
    return different, roots


def settled(links: DataFrame, folder: str, name: str) -> DataFrame:
    """(node, root) of ``links``, stored, without the tables of the rounds."""
    roots = stored(connected(links, f"{folder}/{name}"), f"{folder}/{name}-roots")
    removed(links.sparkSession, f"{folder}/{name}")
    return roots


def one_of_each(docs: DataFrame) -> DataFrame:
    """The smallest row of each group of near copies, with the columns of ``docs``."""
    different, roots = near_copies(docs)
    named = different.join(roots.withColumnRenamed("node", "name"), "name", "left")
    named = named.withColumn("root", F.coalesce("root", "name"))
    return kept_rows(docs, named.groupBy("root").agg(F.min("first").alias("first")))
