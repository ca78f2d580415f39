"""Distinct counts that can be added up again: bitmaps (exact) and sketches (approximate).

A count of different vendors per month says nothing about the year. A bitmap or a sketch of them
does: those of the months are merged. Bitmaps need whole numbers as ids, best without gaps
(``dense_ids``); one bitmap covers 32,768 ids and takes four kilobytes, and rows are kept per bitmap,
so any number of ids is exact and no group is held whole in a task.

Several columns are counted in one pass: rows are grouped by the bitmaps they fall into, not repeated
for every column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from projectmart.sources.tables import ensure_checkpoints

SKETCH_BITS = 12


def dense_ids(df: DataFrame, column: str) -> DataFrame:
    """(value, id): the known values of a column, numbered from 0 in ascending order.

    Values are sorted in ranges and numbered inside each; only the sizes of the ranges meet in one
    place. The sorted values are checkpointed, since ranges drawn anew could differ.
    """
    ensure_checkpoints(df.sparkSession)
    ranges = (
        df.select(F.col(column).alias("value"))
        .dropna()
        .distinct()
        .repartitionByRange("value")
        .sortWithinPartitions("value")
        .select("value", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("n"))
        .checkpoint()
    )
    sizes = ranges.groupBy("part").agg(F.count("*").alias("size"), F.min("n").alias("first"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    moved = sizes.select(
        "part", (F.coalesce(F.sum("size").over(before), F.lit(0)) - F.col("first")).alias("by")
    )
    return ranges.join(moved, "part").select("value", (F.col("n") + F.col("by")).alias("id"))


def with_id(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Add ``<column>_number``; unknown and missing values have none."""
    named = ids.select(F.col("value").alias(column), F.col("id").alias(f"{column}_number"))
    return df.join(named, column, "left")


def bitmap_mart(df: DataFrame, groups: Sequence[str], ids: Mapping[str, Column]) -> DataFrame:
    """One row per group and combination of bitmaps; ``ids`` names the counted columns of numbers.

    Columns: the groups, and ``<name>_bucket`` and ``<name>_bits`` for every name.
    """
    buckets = [F.bitmap_bucket_number(c).alias(f"{n}_bucket") for n, c in ids.items()]
    bits = [
        F.bitmap_construct_agg(F.bitmap_bit_position(c)).alias(f"{n}_bits") for n, c in ids.items()
    ]
    return df.groupBy(*groups, *buckets).agg(*bits)


def bitmap_counts(mart: DataFrame, groups: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Exact distinct counts of any coarser ``groups`` of a bitmap mart: one column per name."""
    parts = [
        mart.groupBy(*groups, f"{n}_bucket")
        .agg(F.bitmap_or_agg(f"{n}_bits").alias("bits"))
        .groupBy(*groups)
        .agg(F.sum(F.bitmap_count("bits")).alias("n"))
        .select(*groups, F.lit(n).alias("_name"), "n")
        for n in names
    ]
    together = reduce(DataFrame.unionByName, parts)
    return together.groupBy(*groups).agg(
        *[F.max(F.when(F.col("_name") == n, F.col("n"))).alias(n) for n in names]
    )


def sketch_mart(
    df: DataFrame, groups: Sequence[str], columns: Mapping[str, Column], bits: int = SKETCH_BITS
) -> DataFrame:
    """One row per group with a sketch of the different values of every column.

    A sketch takes about 2^bits bytes, whatever the number of values; its standard error is about
    1 / sqrt(2^bits).
    """
    return df.groupBy(*groups).agg(
        *[F.hll_sketch_agg(c, bits).alias(f"{n}_sketch") for n, c in columns.items()]
    )


def sketch_counts(mart: DataFrame, groups: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Approximate distinct counts of any coarser ``groups`` of a sketch mart."""
    merged = [F.hll_sketch_estimate(F.hll_union_agg(f"{n}_sketch")).alias(n) for n in names]
    return mart.groupBy(*groups).agg(*merged)
