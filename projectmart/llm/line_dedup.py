"""Line dedup: lines that many documents hold stay only in the document with the largest id.

Hashes of line keys are range-partitioned together with a salt of the document, so that a line that
a third of all documents hold fills many partitions. Inside a range, rows are in the order of hash,
document (largest first) and position; the first row of every document is found by looking one row
back. Counts per hash and salt are added up per hash, and the answer is a keep bitmap per document
in run-length form, not text.

Defined results: a null or empty text is one empty line. A null document id counts as one document,
the smallest. Repeated rows of a document count once; rows that share an id but not a text are
judged each by its own lines. An empty table gives no rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from projectmart.llm.storage import stored, work_folder

WHITE = " \t\n\x0b\x0c\r"
SALTS = 64
NULL_ID = -(2**63)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII values take the faster built-in path."""
    ascii_only = F.length(c) == F.octet_length(c)
    return F.when(ascii_only, F.lower(c)).otherwise(
        F.translate(c, string.ascii_uppercase, string.ascii_lowercase)
    )


def _identified(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumns(
        {
            "_doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)),
            "_digest": F.xxhash64(text),
            "_lines": F.split(text, "\n"),
        }
    )


def keep_bitmaps(docs: DataFrame, folder: str, least_length: int = 40, least_docs: int = 5):
    """Per document that loses lines: (_doc, _digest, n_dropped, keep_runs).

    ``keep_runs`` is the bitmap of kept lines as runs of ones (start, length), in order.
    """
    lines = (
        _identified(docs.select("doc_id", "text"))
        .select(
            "_doc",
            "_digest",
            F.size("_lines").alias("n_lines"),
            F.posexplode("_lines").alias("position", "line"),
        )
        .withColumn("key", F.btrim("line", F.lit(WHITE)))
        .filter(F.length("key") >= least_length)
        .withColumn("key", ascii_lower(F.col("key")))
        .select(
            # Two hashes of different seeds: 128 bits.
            F.xxhash64("key").alias("h1"),
            F.xxhash64(F.lit(1), F.col("key")).alias("h2"),
            F.pmod(F.xxhash64("_doc"), F.lit(SALTS)).alias("salt"),
            "_doc",
            "_digest",
            "position",
            "n_lines",
        )
    )
    lines = stored(lines, f"{folder}/lines")
    in_range = Window.partitionBy("h1", "h2", "salt").orderBy(F.desc("_doc"), "_digest", "position")
    streamed = lines.repartitionByRange("h1", "h2", "salt").withColumn(
        "first_of_doc", F.coalesce(F.lag("_doc").over(in_range) != F.col("_doc"), F.lit(True))
    )
    salted = (
        streamed.filter("first_of_doc")
        .groupBy("h1", "h2", "salt")
        .agg(F.count("*").alias("n"), F.max("_doc").alias("last"))
    )
    # At most as many rows of a key as there are salts; the join keeps the salt, so that no task
    # receives all lines of a key.
    of_key = Window.partitionBy("h1", "h2")
    repeated = (
        salted.withColumns(
            {"n_docs": F.sum("n").over(of_key), "holder": F.max("last").over(of_key)}
        )
        .filter(F.col("n_docs") >= least_docs)
        .select("h1", "h2", "salt", "holder")
    )
    dropped = (
        lines.join(repeated, ["h1", "h2", "salt"])
        .filter(F.col("_doc") != F.col("holder"))
        .groupBy("_doc", "_digest")
        .agg(
            F.sort_array(F.collect_set("position")).alias("dropped"),
            F.first("n_lines").alias("n_lines"),
        )
    )
    runs = F.filter(
        F.transform(
            F.concat(F.array(F.lit(-1)), F.col("dropped")),
            lambda d, i: F.struct(
                (d + 1).alias("start"),
                (F.coalesce(F.get(F.col("dropped"), i), F.col("n_lines")) - d - 1).alias("length"),
            ),
        ),
        lambda r: r["length"] > 0,
    )
    return dropped.select(
        "_doc", "_digest", F.size("dropped").cast("long").alias("n_dropped"), runs.alias("keep_runs")
    )


def dedup_lines(
    docs: DataFrame, least_length: int = 40, least_docs: int = 5, folder: str | None = None
) -> DataFrame:
    """``docs`` with struct ``_row`` (the input row), ``n_lines``, ``n_dropped``, ``kept_text``."""
    folder = folder or work_folder(docs.sparkSession)
    keep = keep_bitmaps(docs, folder, least_length, least_docs)
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), "doc_id", "text")
    joined = _identified(packed).join(keep, ["_doc", "_digest"], "left")
    kept = F.array_join(
        F.flatten(
            F.transform(
                "keep_runs", lambda r: F.slice(F.col("_lines"), r["start"] + 1, r["length"])
            )
        ),
        "\n",
    )
    return joined.select(
        "_row",
        "doc_id",
        F.size("_lines").cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
        F.when(F.col("keep_runs").isNull(), F.coalesce("text", F.lit(""))).otherwise(kept).alias("kept_text"),
    )
