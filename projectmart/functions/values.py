"""Repairs and derived values of single columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from projectmart.functions import fixed_values as V

# Money is summed and compared in decimal: the result then does not depend on the order in which
# partitions arrive. Results are handed back as double, the type of the raw columns.
MONEY = "decimal(28,4)"


def literals(constructor: str, items: Iterable[str | int | None]) -> Column:
    """A constant ``array`` or ``map``, parsed as one expression instead of built item by item."""

    def text(item: str | int | None) -> str:
        if item is None:
            return "NULL"
        if isinstance(item, int):
            return str(item)
        escaped = item.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"

    return F.expr(f"{constructor}({', '.join(map(text, items))})")


def fold(text: Column) -> Column:
    """Lower case without blanks at the ends; tabs stay."""
    return F.lower(F.trim(text))


def map_enum(
    text: Column,
    valid: Sequence[str],
    variants: Mapping[str, str] | None = None,
    *,
    keep_unmapped: bool = False,
) -> Column:
    """Fold, then replace known variants; anything else becomes NULL or stays folded."""
    words = {**{v: v for v in valid}, **(variants or {})}
    folded = fold(text)
    mapped = F.try_element_at(literals("map", chain.from_iterable(words.items())), folded)
    return F.coalesce(mapped, folded) if keep_unmapped else mapped


def parse_bool(text: Column) -> Column:
    word = fold(text)
    return F.when(word.isin(*V.TRUE_WORDS), F.lit(True)).when(
        word.isin(*V.FALSE_WORDS), F.lit(False)
    )


def matches_flag(text: Column, pattern: str) -> Column:
    """Whether the text matches; FALSE for NULL."""
    return F.coalesce(text.rlike(pattern), F.lit(False))


def null_unless_matches(text: Column, pattern: str) -> Column:
    return F.when(text.rlike(pattern), text)


def null_outside(value: Column, low: int = V.SCORE_MIN, high: int = V.SCORE_MAX) -> Column:
    return F.when(value.between(low, high), value)


def round_half_up(value: Column, scale: int) -> Column:
    """Round a double once, at its decimal digits (1.005 -> 1.01), not at its binary value."""
    return F.round(value.cast("double"), scale)


def variance(budget: Column, actual: Column) -> Column:
    """|budget| - |actual|, two places."""
    difference = F.abs(budget).cast(MONEY) - F.abs(actual).cast(MONEY)
    return F.round(difference, 2).cast("double")


def weighted_score(
    scores: Mapping[str, Column], weights: Mapping[str, str] = V.SCORE_WEIGHTS
) -> Column:
    """Weighted sum of the scores, two places; NULL as soon as one score is NULL."""
    terms = [
        scores[name].cast("decimal(10,0)") * F.lit(weight).cast("decimal(3,2)")
        for name, weight in weights.items()
    ]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return F.round(total, 2).cast("double")


def over_invoiced(invoiced: Column, value: Column) -> Column:
    """|invoiced| > |value|; FALSE when one is unknown."""
    return F.coalesce(F.abs(invoiced) > F.abs(value), F.lit(False))


def delay_days(status: Column, actual: Column, planned: Column) -> Column:
    """Days from planned to actual, known for complete milestones only."""
    return F.when(status == "complete", F.datediff(actual, planned))


def null_if_before(date: Column, earliest: Column) -> Column:
    """NULL when the date lies before the other one; an unknown other date changes nothing."""
    return F.when(date < earliest, F.lit(None)).otherwise(date)


def days_overdue(status: Column, due: Column, as_of: Column) -> Column:
    """Days past due for invoices that are not paid; 0 for paid, unknown status or due date."""
    late = F.greatest(F.datediff(as_of, due), F.lit(0))
    return F.when((status != "paid") & due.isNotNull(), late).otherwise(F.lit(0))


def aging_bucket(days: Column) -> Column:
    """Bucket label of a day count. NULL is in the last, open bucket."""
    (first_bound, first_label), *others = V.AGING_BUCKETS
    bucket = F.when(days <= first_bound, first_label)
    for bound, label in others:
        bucket = bucket.when(days <= bound, label)
    return bucket.otherwise(V.AGING_LAST)


def risk_bucket(probability: Column) -> Column:
    """Level of a probability; buckets are open on the left, so exactly 0 has no level."""
    bucket = F.when(probability <= 0, F.lit(None))
    for bound, label in V.PROBABILITY_BUCKETS:
        bucket = bucket.when(probability <= bound, label)
    return bucket


def as_of_date(as_of: str | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def stamp(df: DataFrame, column: str = "ingestion_timestamp") -> DataFrame:
    return df.withColumn(column, F.current_timestamp())


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in ("double", "int", "bigint")]


def fill_numeric(df: DataFrame, value: int = 0, exclude: Sequence[str] = ()) -> DataFrame:
    """Replace NULL in every numeric column but the excluded ones."""
    return df.fillna(value, subset=[c for c in numeric_columns(df) if c not in exclude])
