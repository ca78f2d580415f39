"""Groups of spelling variants by dense prefix-suffix tiling.

Two words differ by one edit exactly if their common prefix and common suffix together reach the
longer length minus one. Words are put into groups in which that may hold: for the longer length and
a zone of places, the words that agree before and after the zone. Every near pair of words meets in
the group whose zone holds the end of its common prefix, and is taken there alone. A group of too many words is split
by halving its zone, which leaves fewer letters to differ; in a zone of one place, a group has no more
words than there are letters, so groups are bounded however the words are dealt.

Rows of groups are cut into blocks; pairs of blocks are compared at once on padded matrices of code
points, forwards for the prefixes and backwards for the suffixes.

Defined results: a null or empty text has no words; repeated rows count each; a null id is written as
nothing before the colon. Ties of forms go by code-point order. Empty tables give no rows. Texts and
words of any length are taken whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from projectmart.llm.arrays import binary
from projectmart.llm.storage import stored, work_folder

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# One (document, run) in so many loses a letter.
DIVISOR = 97
LEAST_LENGTH, LEAST_COUNT = 5, 3
# A form occurs so many times as often as the word, at least.
TIMES = 2
# Different words that a task adds up before it hands them on.
HELD_WORDS = 300_000
# Texts above this are read word by word.
LONG_TEXT = 4 << 20
# Most words of a group, rows of a block, and cells of a compared pair of blocks.
MOST, BLOCK, CELLS = 512, 128, 8 << 20

GROUP = ["longest", "low", "high", "outside"]


def counted_runs(doc, text: bytes) -> Iterator[tuple[str, int]]:
    """Runs of a text with the lost letters, and how often they occur."""
    lowered = text.translate(LOWER).decode()
    if len(text) > LONG_TEXT:
        runs = Counter(m[0] for m in RUN.finditer(lowered))
    else:
        runs = Counter(RUN.findall(lowered))
    seed = zlib.crc32(b"%s:" % (b"" if doc is None else str(doc).encode()))
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), seed)
        if h % DIVISOR == 0:
            i = h % len(run)
            run = run[:i] + run[i + 1 :]
        yield run, n


def _counted(batches):
    totals: Counter = Counter()

    def handed_on():
        words, counts = list(totals), list(totals.values())
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64())], names=["word", "n"])

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), binary(batch.column(1))):
            for run, n in counted_runs(doc, text.as_py() or b""):
                if len(run) >= LEAST_LENGTH:
                    totals[run] += n
            if len(totals) >= HELD_WORDS:
                yield handed_on()
                totals.clear()
    if totals:
        yield handed_on()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all words of ``docs`` (doc_id, text)."""
    counted = docs.select("doc_id", "text").mapInArrow(_counted, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def grouped(rows: DataFrame) -> DataFrame:
    """Rows (word, n, longest, low, high) with the digest of what stands outside the zone."""
    before = F.expr("substring(word, 1, low)")
    after = F.expr("substring(word, length(word) - (longest - high) + 1, longest - high)")
    return rows.withColumn("outside", F.xxhash64(before, F.lit(0), after))


def halves(rows: DataFrame) -> DataFrame:
    """Each row with the first and with the second half of its zone."""
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    zones = F.array(
        F.struct(F.col("low").alias("low"), middle.alias("high")),
        F.struct(middle.alias("low"), F.col("high").alias("high")),
    )
    return grouped(rows.select("word", "n", "longest", F.explode(zones).alias("zone")).select("word", "n", "longest", "zone.*"))


def groups(words: DataFrame, folder: str) -> list[DataFrame]:
    """Tables of groups of at most ``MOST`` words each, or with a zone of one place."""
    lengths = F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("longest")
    whole = words.select("word", "n", lengths).withColumn("low", F.lit(0)).withColumn("high", F.col("longest"))
    rows, ready = halves(whole), []
    while True:
        nth = len(ready)
        sizes = rows.groupBy(*GROUP).count()
        large = sizes.filter((F.col("count") > MOST) & (F.col("high") - F.col("low") > 1))
        marked = rows.join(large.select(*GROUP, F.lit(True).alias("large")), GROUP, "left")
        marked = stored(marked.withColumn("large", F.col("large").isNotNull()), f"{folder}/groups-{nth}")
        ready.append(marked.filter("NOT large").drop("large"))
        rest = marked.filter("large").drop("large")
        if rest.isEmpty():
            return ready
        rows = halves(rest)


def _agreement(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many first cells agree, for each row of x and each row of y."""
    same = np.ones((len(x), len(y), x.shape[1] + 1), bool)
    np.equal(x[:, None, :], y[None, :, :], out=same[:, :, :-1])
    same[:, :, -1] = False
    return same.argmin(axis=2)


class _Block:
    """Rows of groups as padded matrices of code points, forwards and backwards."""

    def __init__(self, words: list[str], group: np.ndarray, zone: np.ndarray):
        self.words, self.group, self.zone = words, group, zone
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.width = int(self.lengths.max())

    def matrix(self, width: int, backwards: bool, pad: int) -> np.ndarray:
        words = [w[::-1] for w in self.words] if backwards else self.words
        cells = np.array(words, f"<U{width}").view(np.uint32).reshape(len(words), width)
        # Letters are below 256; what pads one side never equals what pads the other.
        return np.where(cells, cells, pad).astype(np.uint8)


def _compare(x: _Block, y: _Block, same_block: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of near pairs of two blocks."""
    width = max(x.width, y.width)
    prefix = _agreement(x.matrix(width, False, 0), y.matrix(width, False, 1))
    suffix = _agreement(x.matrix(width, True, 0), y.matrix(width, True, 1))
    longer = np.maximum(x.lengths[:, None], y.lengths[None, :])
    at = np.minimum(prefix, longer - 1)
    near = prefix + suffix >= longer - 1
    near &= np.abs(x.lengths[:, None] - y.lengths[None, :]) <= 1
    near &= x.group[:, None] == y.group[None, :]
    # The pair belongs to the group of its longer length and of the zone where the prefix ends.
    near &= (x.zone[:, 0, None] == longer) & (x.zone[:, 1, None] <= at) & (at < x.zone[:, 2, None])
    if same_block:
        near = np.triu(near, 1)
    return np.nonzero(near)


def _blocks(words: list[str], group: np.ndarray, zone: np.ndarray) -> Iterator[_Block]:
    low = 0
    while low < len(words):
        widest = max(map(len, words[low : low + BLOCK]))
        rows = max(1, min(BLOCK, int((CELLS / widest) ** 0.5)))
        yield _Block(words[low : low + rows], group[low : low + rows], zone[low : low + rows])
        low += rows


def _near(batches):
    """Near pairs, both ways, of rows that come sorted by group."""

    def compared(words, counts, group, zone):
        found, open_blocks, low = [], [], 0
        for block in _blocks(words, group, zone):
            # Only blocks that end in the group this one starts with can share a group with it.
            open_blocks = [b for b in open_blocks if b[0].group[-1] == block.group[0]]
            for other, start in [*open_blocks, (block, low)]:
                i, j = _compare(other, block, other is block)
                found += [(start + i, low + j)] * bool(len(i))
            open_blocks.append((block, low))
            low += len(block.words)
        if not found:
            return None
        a, b = (np.concatenate(x) for x in zip(*found))
        a, b = np.concatenate([a, b]), np.concatenate([b, a])
        words = pa.array(words, pa.string())
        return pa.RecordBatch.from_arrays(
            [words.take(pa.array(a)), words.take(pa.array(b)), pa.array(counts[b])],
            names=["word", "near", "near_n"],
        )

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches(([] if held is None else held.to_batches()) + [batch])
        keys = np.stack([table.column(c).to_numpy().astype(np.int64) for c in GROUP], axis=1)
        new = np.append(True, (keys[1:] != keys[:-1]).any(axis=1))
        cut = int(np.flatnonzero(new)[-1])
        # The last group may go on in the next batch.
        held = table.slice(cut)
        if cut:
            out = compared(*_columns(table.slice(0, cut), new[:cut], keys[:cut]))
            if out is not None:
                yield out
    if held is not None:
        keys = np.stack([held.column(c).to_numpy().astype(np.int64) for c in GROUP], axis=1)
        out = compared(*_columns(held, np.append(True, np.zeros(len(keys) - 1, bool)), keys))
        if out is not None:
            yield out


def _columns(table: pa.Table, new: np.ndarray, keys: np.ndarray):
    return table.column("word").to_pylist(), table.column("n").to_numpy(), np.cumsum(new), keys[:, :3]


def near_words(words: DataFrame, folder: str) -> DataFrame:
    """(word, near, near_n) of all near pairs of ``words`` (word, n), both ways, each once."""
    rows, *more = groups(words, folder)
    for table in more:
        rows = rows.union(table)
    rows = rows.select("word", "n", *GROUP).repartition(*GROUP).sortWithinPartitions(*GROUP)
    return rows.mapInArrow(_near, "word string, near string, near_n bigint")


def roots(forms: DataFrame, folder: str) -> DataFrame:
    """(word, root) by following ``forms`` (word, form) to the last, twice as far each round.

    A form occurs at least ``TIMES`` times as often as its word, so chains are short and end.
    """
    reached = stored(forms.select("word", F.col("form").alias("root")), f"{folder}/roots-0")
    nth = 0
    while True:
        nth += 1
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = reached.join(onward, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        )
        step = stored(step, f"{folder}/roots-{nth}")
        reached = step.drop("moved")
        if step.filter("moved").isEmpty():
            return reached


def spelling_variants(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """One row per word of ``docs`` (doc_id, text): word, n, form, root, n_near, form_n."""
    folder = folder or work_folder(docs.sparkSession)
    words = stored(word_counts(docs), f"{folder}/words")
    best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), "near")).alias("best")
    near = near_words(words, folder).groupBy("word").agg(F.count("*").alias("n_near"), best)
    often = -F.col("best.minus_n") >= TIMES * F.col("n")
    judged = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(often, F.col("best.near")).alias("form"),
        F.when(often, -F.col("best.minus_n")).alias("form_n"),
    )
    judged = stored(judged, f"{folder}/judged")
    ends = roots(judged.filter("form IS NOT NULL"), folder)
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
