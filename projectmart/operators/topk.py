"""Ordered and limited results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_k(
    df: DataFrame, by: str, k: int, *, ascending: bool = False, tie_break: Sequence[str] = ()
) -> DataFrame:
    """The k first rows by one column. NULL is last when descending and first when ascending.

    Give ``tie_break`` columns that are unique together, or the rows at the cut are arbitrary.
    """
    first = F.col(by).asc_nulls_first() if ascending else F.col(by).desc_nulls_last()
    return df.orderBy(first, *[F.col(c).asc_nulls_first() for c in tie_break]).limit(k)
