"""Aggregates used by the marts. All keep partial aggregation before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from projectmart.functions.values import MONEY, round_half_up


# Ten-thousandths below this, and off a whole number by less than that, are surely rounded right.
SURE, OFF = float(1 << 50), 0.4


def money_total(value: Column) -> Column:
    """Exact sum as decimal of values rounded to four places.

    A cast to decimal goes by the digits of each value, which costs more than all the rest. A value
    times 10,000 is off by less than an eighth if it is below 2^50; unless it lies near the middle
    between two whole numbers, it so rounds to the one that the digits say. Other values are cast. All
    are added up as whole numbers in one decimal, so a shuffle moves one number for a sum.
    """
    scaled = value * F.lit(10_000.0)
    whole = F.rint(scaled)
    sure = (F.abs(scaled) < SURE) & (F.abs(scaled - whole) < OFF)
    by_digits = (value.cast(MONEY) * F.lit(10_000)).cast("decimal(28,0)")
    units = F.sum(F.when(sure, whole.cast("bigint").cast("decimal(28,0)")).otherwise(by_digits))
    return (units * F.lit("0.0001").cast("decimal(4,4)")).cast("decimal(38,4)")


def money_sum(value: Column) -> Column:
    """Exact sum as double."""
    return money_total(value).cast("double")


def mean(value: Column) -> Column:
    """Average that does not depend on the order of the rows."""
    return F.try_divide(money_sum(value), F.count(value).cast("double"))


def avg_if(condition: Column, value: Column) -> Column:
    return F.avg(F.when(condition, value))


def n_distinct(value: Column, approx: bool = False) -> Column:
    return F.approx_count_distinct(value) if approx else F.count_distinct(value)


def n_values(value: Column) -> Column:
    """The exact number of distinct values, beside wide sums.

    ``n_distinct`` plans two shuffles, and the first moves a row, with all sums, for each group and
    value. Here a set is kept beside the sums, so one shuffle moves a row for each group. A set has to
    fit into the memory of a task, as one of the vendors of a project does.
    """
    return F.size(F.collect_set(value)).cast("bigint")


def pct(part: Column, whole: Column, scale: int = 2) -> Column:
    """part / whole * 100, rounded; NULL for a zero or unknown whole."""
    percent = F.try_divide(part.cast("double"), whole.cast("double")) * 100.0
    return round_half_up(percent, scale)


def hundredths(part: Column, whole: Column, scale: int = 2) -> Column:
    """part * 100 / whole, rounded: the order of the declarative path, which can differ from
    ``pct`` in the last place."""
    percent = F.try_divide(part.cast("double") * 100.0, whole.cast("double"))
    return round_half_up(percent, scale)


def ratio(part: Column, whole: Column, scale: int = 4) -> Column:
    return round_half_up(F.try_divide(part.cast("double"), whole.cast("double")), scale)


def frequencies(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("count"))


def key_health(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, rows without key, keys that occur more than once.

    Rows without key form one group, so several of them count as one duplicate. Rows are counted
    per key first, hence a hot key reaches the shuffle as one row per task.
    """
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("null_pk"),
        F.count_if(F.col("n") > 1).alias("dup_pk"),
    )


def duplicate_key_groups(df: DataFrame, key: str) -> DataFrame:
    """The keys that occur more than once, with their counts."""
    return df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")
