"""Named row expectations."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def _holds(predicate: Column, null_passes: bool) -> Column:
    return F.coalesce(predicate, F.lit(null_passes))


def violations(
    df: DataFrame, rules: Mapping[str, Column], *, null_passes: bool = False
) -> DataFrame:
    """One row per rule: rows checked and rows that break it, from one pass over the data."""
    counts = df.agg(
        F.count("*").alias("rows"),
        *[
            F.count_if(~_holds(predicate, null_passes)).alias(f"v{i}")
            for i, predicate in enumerate(rules.values())
        ],
    )
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("rule"), F.col(f"v{i}").alias("violations"))
            for i, name in enumerate(rules)
        ]
    )
    return counts.select("rows", F.explode(pairs).alias("r")).select("r.rule", "rows", "r.violations")


def counted(rules: Mapping[str, Column], null_passes: bool = False) -> list[Column]:
    """The number of rows, and for each rule of those that break it."""
    metrics = [
        F.count_if(~_holds(predicate, null_passes)).alias(name) for name, predicate in rules.items()
    ]
    return [F.count(F.lit(1)).alias("rows"), *metrics]


def _observed(
    df: DataFrame, rules: Mapping[str, Column], null_passes: bool, observation: Observation | None
) -> DataFrame:
    if observation is None:
        return df
    return df.observe(observation, *counted(rules, null_passes))


def expect(
    df: DataFrame,
    rules: Mapping[str, Column],
    *,
    null_passes: bool = False,
    observation: Observation | None = None,
) -> DataFrame:
    """Keep all rows; count the violations in ``observation`` while the frame is written."""
    return _observed(df, rules, null_passes, observation)


def expect_or_drop(
    df: DataFrame,
    rules: Mapping[str, Column],
    *,
    null_passes: bool = False,
    observation: Observation | None = None,
) -> DataFrame:
    """Keep the rows that meet every rule; count the violations as ``expect`` does."""
    kept = _observed(df, rules, null_passes, observation)
    for predicate in rules.values():
        kept = kept.filter(_holds(predicate, null_passes))
    return kept
