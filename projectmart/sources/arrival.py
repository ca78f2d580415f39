"""The order in which rows arrived, taken from the files they lie in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ARRIVAL = "_arrival"


def with_arrival(df: DataFrame, delivery: Column | None = None) -> DataFrame:
    """Add ``_arrival``, which orders the rows of a file table by arrival.

    First comes the delivery: a column that numbers or dates deliveries, such as the folder they
    were put in, or else the time at which the file was written. Files of one delivery go by name and
    rows by their place in the file. Nothing is sorted or numbered for that, so it costs no shuffle, and
    a task that runs again sees the same order.

    ``df`` is a scan of Parquet files or of a table of them, before any other operator.
    """
    meta = F.col("_metadata")
    written = meta.file_modification_time if delivery is None else delivery
    arrival = F.struct(
        written.alias("delivery"), meta.file_name.alias("file"), meta.row_index.alias("row")
    )
    return df.withColumn(ARRIVAL, arrival)
