"""Defects for test tables, as column operators.

A row is dirty when its integer key has a given remainder. So the same rows are dirty in every
engine and at every size, and no random state or driver loop is needed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from projectmart.functions.values import literals


def hit(key: Column, modulus: int, residue: int) -> Column:
    return key % modulus == residue


def div(key: Column, modulus: int) -> Column:
    return F.call_function("div", key, F.lit(modulus))


def pick(pool: Sequence[str | int | None], n: Column) -> Column:
    """Element ``n mod len`` of a fixed list."""
    return F.get(literals("array", pool), (n % len(pool)).cast("int"))


def nulled(value: Column, key: Column, modulus: int = 41, residue: int = 7) -> Column:
    return F.when(~hit(key, modulus, residue), value)


def swapped(
    value: Column, key: Column, pool: Sequence[str | int | None], modulus: int, residue: int
) -> Column:
    """Replace the value by a member of the pool."""
    return F.when(hit(key, modulus, residue), pick(pool, div(key, modulus))).otherwise(value)


def dirty_enum(value: Column, key: Column, pool: Sequence[str]) -> Column:
    return swapped(value, key, pool, 11, 3)


def dirty_key(value: Column, key: Column, pool: Sequence[str | None]) -> Column:
    return swapped(value, key, pool, 17, 2)


def dirty_score(value: Column, key: Column) -> Column:
    return swapped(value, key, (-1, 0, 11, 15, 100, None), 19, 4)


def dirty_bool(value: Column, key: Column, pool: Sequence[str]) -> Column:
    return swapped(value, key, pool, 13, 8)


def dirty_business_id(value: Column, key: Column) -> Column:
    return swapped(value, key, ("12345", "ABCDEFG-H", "0000000-0", "", None), 31, 11)


# Other orders of the parts of an ISO date, as replacements; @ stands for the name of the month.
_DATE_ORDERS = ("$3/$2/$1", "$1$2$3", "$3-@-$1", "$2-$3-$1")
_MONTH_ORDERS = ("$1-$2", "$3/$2/$1", "@ $1")
_ISO_PARTS = r"(\d+)-(\d+)-(\d+)"


def _dirty_text(
    date: Column, key: Column, residue: int, orders: Sequence[str], month: str
) -> Column:
    """Text of a date: ISO, for some keys with its parts in another order.

    Rearranging text keeps the generated code of wide tables small enough to be compiled.
    """
    iso = date.cast("string")
    rearranged = F.regexp_replace(iso, F.lit(_ISO_PARTS), pick(orders, div(key, 13)))
    dirty = F.replace(rearranged, F.lit("@"), F.date_format(date, month))
    return F.when(hit(key, 13, residue), dirty).otherwise(iso)


def dirty_date(date: Column, key: Column) -> Column:
    """A date as text, for some keys in one of four other formats."""
    return _dirty_text(date, key, 5, _DATE_ORDERS, "MMM")


def dirty_month(date: Column, key: Column) -> Column:
    """The first of a month as text, for some keys in one of three other formats."""
    return _dirty_text(date, key, 6, _MONTH_ORDERS, "MMMM")


def negated(value: Column, key: Column) -> Column:
    return F.when(hit(key, 23, 1), -F.abs(value)).otherwise(value)


def wrong(value: Column, key: Column, other: Column) -> Column:
    """A stale derived value."""
    return F.when(hit(key, 7, 6), other).otherwise(value)


def illogical(value: Column, key: Column, other: Column, where: Column) -> Column:
    """A value that contradicts the other columns of the row."""
    return F.when(hit(key, 29, 9) & where, other).otherwise(value)


def with_duplicates(df: DataFrame, chosen: Column, overrides: Mapping[str, Column]) -> DataFrame:
    """Append a copy of the chosen rows that differs in some columns."""
    return df.unionByName(df.filter(chosen).withColumns(dict(overrides)))
