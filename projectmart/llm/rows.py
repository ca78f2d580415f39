"""Rows named by a digest, so that one row of a group can be found again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A digest of id and text, equal for repeated rows; null and empty texts are the same."""
    id_ = F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")
    body = F.coalesce(F.col(text).cast("binary"), F.lit("").cast("binary"))
    return F.md5(F.concat(id_, F.lit(":").cast("binary"), body))


def id_order() -> Column:
    """(no_id, doc_id, row): its smallest value is the row that stays; rows without id come last."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")


def kept_rows(docs: DataFrame, first: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``first`` (first: id and row key) names, each once.

    Rows travel packed, so that no column of theirs can clash with a helper's.
    """
    keep = first.select(F.col("first.row").alias("keep"))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    packed = docs.select(whole, row_key().alias("key"))
    kept = packed.join(keep, F.col("key") == F.col("keep"), "left_semi").dropDuplicates(["key"])
    return kept.select(*[F.col(f"whole.`{c}`").alias(c) for c in docs.columns])
