"""Dates and months that arrive as text in several formats."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from projectmart.functions.fixed_values import FIVE_FORMATS, MONTH_FORMATS

ISO = "yyyy-MM-dd"


def _iso_date(text: Column) -> Column:
    """``yyyy-MM-dd`` by a cast, which costs less than a formatter.

    The cast alone takes more than the format does (short months, a time part, blanks around), so
    it is only used on text of exactly that shape.
    """
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))


def parse_date(text: Column, formats: Sequence[str] = FIVE_FORMATS) -> Column:
    """The date in the first format that fits, else NULL. Never raises, also not in ANSI mode."""
    return F.coalesce(
        *[_iso_date(text) if fmt == ISO else F.try_to_date(text, fmt) for fmt in formats]
    )


def parse_month(text: Column, formats: Sequence[str] = MONTH_FORMATS) -> Column:
    """The first day of a month given as a date, ``yyyy-MM`` or a name and a year."""
    parsed = [
        _iso_date(F.concat(text, F.lit("-01"))) if fmt == "yyyy-MM" else parse_date(text, [fmt])
        for fmt in formats
    ]
    return F.coalesce(*parsed)


def add_suffix(name: str) -> str:
    """``start_date`` -> ``start_date_dt``."""
    return f"{name}_dt"


def strip_date_suffix(name: str) -> str:
    """``start_date`` -> ``start_dt``; a name that ends in ``_dt`` stays."""
    if name.endswith("_dt"):
        return name
    return f"{name.replace('_date', '').replace('_str', '')}_dt"


def parse_dates(
    df: DataFrame,
    *columns: str,
    formats: Sequence[str] = FIVE_FORMATS,
    rename: Callable[[str], str] = add_suffix,
) -> DataFrame:
    """Add a parsed date column for each text column."""
    return df.withColumns({rename(c): parse_date(F.col(c), formats) for c in columns})


def year_month(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")
