from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import types as T  # noqa: E402

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        # Names that the operators use themselves.
        T.StructField("key", T.StringType()),
        T.StructField("kept", T.StringType()),
        T.StructField("n_words", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def frame(spark):
    def build(rows):
        full = [(doc, text, "key", None, 7) for doc, text in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return build


@pytest.fixture(scope="session")
def corpus(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    return [(r["doc_id"], r["text"]) for r in rows]


@pytest.fixture(scope="session")
def odd():
    """Nulls, empty and long texts, ties and copies."""
    line = "this line is longer than forty characters, and it is repeated"
    passage = " ".join(f"word{i}" for i in range(60))
    rows = [
        (1, None),
        (2, ""),
        (3, " \t\n"),
        (4, "a"),
        (5, "Short text, ÉÀ ñandú.\nSecond line."),
        (6, "a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a"),
        (7, passage),
        (8, passage),
        (9, passage.replace("word30", "other")),
        (10, f"before {passage} after"),
        (11, "x" * 300 + " " + "y z " * 700 + passage),
        (12, "no word at all is shared here, but that is all\n" + line),
    ]
    rows += [(20 + i, f"{line.upper()}  \n{i} own line of document number {i}\n\t{line}") for i in range(6)]
    rows += [(30, "mail a.b@c.de now, call +1 (415) 555-2671, 10.0.0.1, 4111 1111 1111 1111")]
    return rows
