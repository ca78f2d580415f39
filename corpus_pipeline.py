"""From raw documents to packed sequences: quality rules, line dedup, near-dedup, decontamination,
packing. Every stage works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from projectmart.llm import decontamination, line_dedup, near_copies, packing, quality
from projectmart.llm.storage import stored, work_folder


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_documents(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(docs)
    changed = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return kept.select(*(changed.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Groups are linked by similarity: shingles of five words, Jaccard 0.8 or more.

    SimHash fingerprints find candidates by Golay keys, which are verified; keys of shingles find the pairs
    whose fingerprints are too far apart, so that none is lost."""
    return near_copies.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.clean_documents(docs, benchmark)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, "byte_bpe_50k.json")


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# Hashes and tokens are beyond SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/stage-{k}")
    return docs
