"""Joins of facts, pre-aggregates and dimensions.

No side carries a broadcast hint: dimensions grow with the data. Adaptive execution broadcasts a
side when its measured size allows it and splits skewed partitions otherwise. Facts are aggregated
to the join key first wherever the result allows it.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from projectmart.operators.aggregates import pct

# Shares of a hot key for each even part that it fills: small ones even out where they meet.
SHARES = 8


def enrich(fact: DataFrame, dim: DataFrame, on: str, columns: Sequence[str]) -> DataFrame:
    """Left join with some columns of a dimension."""
    return fact.join(dim.select(on, *columns), on, "left")


def hot_keys(df: DataFrame, on: str, parts: int, factor: float = 1.0) -> DataFrame:
    """(key, salts): keys with more than ``factor`` times the rows of an even part of ``parts``, and in
    how many shares they are cut, each a fraction of an even part.

    There are fewer than ``parts`` / ``factor`` of them, whatever the data.
    """
    per_key = df.dropna(subset=[on]).groupBy(on).agg(F.count("*").alias("n"))
    even = per_key.agg(F.sum("n") / F.lit(parts / 1.0)).scalar()
    shares = F.ceil(F.col("n") / even / factor).cast("int") * SHARES
    return per_key.filter(F.col("n") > factor * even).select(on, shares.alias("salts"))


def enrich_hot(
    fact: DataFrame, dim: DataFrame, on: str, columns: Sequence[str], parts: int | None = None
) -> DataFrame:
    """Like ``enrich``, for facts that cannot be grouped first and may have hot keys.

    The keys are counted, which costs a shuffle of one row per key and task. Rows of a hot key are dealt
    over shares, and its row of the dimension is repeated for each; the list of hot keys has a fixed
    bound and is broadcast. Rows without key match nothing and are dealt over all shares.
    """
    parts = parts or int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot_keys(fact, on, parts))
    nth = F.monotonically_increasing_id()
    salts = F.when(F.col(on).isNull(), parts).otherwise(F.coalesce("salts", F.lit(1)))
    dealt = fact.join(hot, on, "left").withColumn("_salt", F.pmod(nth, salts).cast("int")).drop("salts")
    shares = F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))
    copies = dim.select(on, *columns).join(hot, on, "left").withColumn("_salt", shares).drop("salts")
    return dealt.join(copies, [on, "_salt"], "left").drop("_salt")


def star(base: DataFrame, parts: Iterable[tuple[DataFrame, str, str]]) -> DataFrame:
    """Join several parts ``(frame, key, how)`` to one base."""
    for part, on, how in parts:
        base = base.join(part, on, how)
    return base


def join_on(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner"
) -> DataFrame:
    """Equi join on differently named keys; both keys stay."""
    return left.join(right, left[left_key] == right[right_key], how)


def orphans(child: DataFrame, parent: DataFrame, on: str) -> DataFrame:
    """Rows of the child whose key is known but not among the parent's.

    The rows themselves are the result, so they cannot be grouped first: hot keys are dealt out.
    """
    known = parent.select(on).dropna().distinct().withColumn("_known", F.lit(True))
    named = enrich_hot(child.dropna(subset=[on]), known, on, ["_known"])
    return named.filter(F.col("_known").isNull()).select(child.columns)


def orphan_rate(child: DataFrame, parent: DataFrame, on: str) -> DataFrame:
    """One row: rows with a key, orphans among them, and their share.

    Counts per key before the join, so that no task receives all rows of a hot key.
    """
    per_key = child.dropna(subset=[on]).groupBy(on).agg(F.count("*").alias("n"))
    known = parent.select(on).dropna().distinct().withColumn("_known", F.lit(True))
    counts = per_key.join(known, on, "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("n"))), F.lit(0)).alias("orphans"),
    )
    share = F.coalesce(pct(F.col("orphans"), F.col("rows")), F.lit(0.0))
    return counts.withColumn("orphan_pct", share)
