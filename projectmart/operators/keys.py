"""Key repair: rows without key, and repeated keys."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A summary of keys has a bit for each of 67 million places, in words of 64: a fixed number of rows.
WORDS = 1 << 20


def first_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None
) -> DataFrame:
    """Keep the first row of every key.

    The order is explicit, by default all columns ascending with NULL first, so the survivor does
    not depend on file order or partitioning. ``row_number() = 1`` lets the optimizer put a group
    limit in front of the shuffle: each task sends at most one row per key, however often a hot
    key occurs.

    The hash in front of the keys changes nothing but the speed of the sort: business keys begin
    alike (``INV-0…``), so their first bytes, which the sort compares first, decide little.
    """
    order = [F.col(c).asc_nulls_first() for c in (order_by or df.columns)]
    window = Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def drop_null_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.dropna(subset=list(keys))


def least_per_key(df: DataFrame, key: str, order_by: Sequence[str] | None = None) -> DataFrame:
    """The rows of ``first_per_key`` by an aggregate, since the first row is the least of its key.

    Each task sends one row per key, too. Who needs the keys alone, as reports on keys do, moves nothing
    else, and what is grouped by the key next finds its rows in place.
    """
    rest = [c for c in df.columns if c != key]
    order = [c for c in (order_by or rest) if c != key]
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    if not order:
        first = F.first(row)
    elif order == rest:
        first = F.min(row)
    else:
        first = F.min_by(row, F.struct(*[F.col(f"`{c}`") for c in order]))
    kept = df.groupBy(key).agg(first.alias("_row"))
    return kept.select(*[F.col(f"`{c}`" if c == key else f"_row.`{c}`") for c in df.columns])


def clean_keys(df: DataFrame, key: str, order_by: Sequence[str] | None = None) -> DataFrame:
    """Drop rows without key, then keep the first row of every key.

    Filtering first also keeps the rows without key, which would all meet in one task, out of the
    shuffle.
    """
    return least_per_key(drop_null_keys(df, key), key, order_by)


def leading(df: DataFrame, key: str, read: Collection[str]) -> DataFrame:
    """``df`` with what follows the last column that is read as unknown, for ``clean_keys``.

    The first row of a key, in the order of all columns, agrees up to any column with the first in
    the order of the columns up to there. So these suffice for those who read no others, and the
    rest need not move.
    """
    others = [c for c in df.columns if c != key]
    kept = {key, *others[: 1 + max((i for i, c in enumerate(others) if c in read), default=-1)]}
    unknown = {f.name: F.lit(None).cast(f.dataType) for f in df.schema.fields if f.name not in kept}
    return df.withColumns(unknown)


def _marked(df: DataFrame, key: str, keys: DataFrame, how: str) -> tuple[DataFrame, Column]:
    """``df`` beside a summary of ``keys``, and whether the bit of the row's key is set there.

    The summary has at most ``WORDS`` rows, however many keys there are, and is broadcast.
    """
    number = F.xxhash64(key)
    word = F.shiftrightunsigned(number, 6).bitwiseAND(F.lit(WORDS - 1))
    bit = number.bitwiseAND(F.lit(63)).cast("int")
    set_bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    words = keys.groupBy(word.alias("_word")).agg(F.bit_or(set_bit).alias("_bits"))
    marked = df.withColumn("_word", word).join(F.broadcast(words), "_word", how)
    return marked, F.getbit(F.coalesce("_bits", F.lit(0).cast("bigint")), bit) == 1


def of_keys(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows with one of some keys. Rows that cannot have one, by a summary of the keys, stay where
    they are; the more keys, the more rows move."""
    marked, hit = _marked(df, key, keys, "inner")
    # A semi join would be planned below the join with the summary, and then move every row.
    return marked.filter(hit).select(df.columns).join(keys.select(key).distinct(), key).select(df.columns)


def without_keys(df: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with none of some keys, in two parts: those that cannot have one, by a summary of the
    keys, which stay where they are, and the others, which had to be looked up. Rows without key count."""
    marked, hit = _marked(df, key, keys, "left")
    doubtful = marked.filter(hit).select(df.columns).join(keys, key, "left_anti")
    return marked.filter(~hit).select(df.columns), doubtful
