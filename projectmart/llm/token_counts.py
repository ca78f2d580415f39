"""Token counts with a digest cache.

The digest of the normalised content and that of the tokenizer (file and version of the library)
name a count. The different digests of the input are joined to the cache; one text of each missing
digest is encoded, and the new counts are appended to the cache. Only ids and digests meet in the
joins of copies; a text moves only to be encoded.

Normalised content: the text with every run of ASCII white space as one space, and none at its
ends. The tokenizer drops white space, and its special strings hold none, so equal normalised
content has equal counts.

Defined results: a null text is empty and has no tokens. Repeated rows are counted from one
encoding. A null id is kept. An empty table gives no rows and appends nothing.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from projectmart.llm.arrays import binary
from projectmart.llm.storage import work_folder
from projectmart.llm.tokens import Memo, chunk_counts, load, tokenizer_path, white_chunks
from projectmart.operators.joins import enrich_hot

LIMIT = 2048
BLOCK_TEXTS = 256
CACHE_SCHEMA = "content string, tokenizer string, n_tokens bigint"


def tokenizer_digest(path: str) -> str:
    """Names the tokenizer: its file and the version of the library."""
    import tokenizers

    with open(path, "rb") as file:
        content = file.read()
    return hashlib.sha256(content + tokenizers.__version__.encode()).hexdigest()


def _counter(name: str):
    def run(batches):
        memo = Memo(chunk_counts(load(tokenizer_path(name))))
        for batch in batches:
            digests, texts = batch.column(0), binary(batch.column(1))
            for low in range(0, batch.num_rows, BLOCK_TEXTS):
                chunks = [white_chunks(t) for t in texts.slice(low, BLOCK_TEXTS).to_pylist()]
                counts = memo.values(chunks)
                yield pa.RecordBatch.from_arrays(
                    [
                        digests.slice(low, BLOCK_TEXTS),
                        pa.array([sum(map(counts.__getitem__, c)) for c in chunks], pa.int64()),
                    ],
                    names=["content", "n_tokens"],
                )

    return run


def read_cache(spark: SparkSession, cache: str) -> DataFrame:
    """The cache, empty as long as nothing was appended."""
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache)
    return spark.read.schema(CACHE_SCHEMA).parquet(cache)


def token_counts(docs: DataFrame, name: str, cache: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row, by the tokenizer file ``name``.

    ``cache`` is a folder that all executors share; without it, a new one is made.
    """
    spark = docs.sparkSession
    folder = work_folder(spark)
    cache = cache or f"{folder}/cache"
    version = tokenizer_digest(tokenizer_path(name))
    text = F.coalesce(F.col("text"), F.lit(""))
    normal = F.btrim(F.regexp_replace(text, "[ \\t\\n\\x0B\\f\\r]+", " "))
    digested = docs.select(
        "doc_id", text.alias("text"), F.sha2(normal, 256).alias("content")
    )
    narrow = digested.select("doc_id", "content", F.octet_length("text").cast("long").alias("n_bytes"))
    narrow.write.parquet(f"{folder}/digests")
    narrow = spark.read.schema(narrow.schema).parquet(f"{folder}/digests")
    known = read_cache(spark, cache).filter(F.col("tokenizer") == version)
    misses = (
        narrow.groupBy("content")
        .agg(F.min("doc_id").alias("of_doc"))
        .join(known, "content", "left_anti")
    )
    # One row of each missing digest: its document of the smallest id.
    wanted = digested.join(
        misses.withColumnRenamed("content", "missing"),
        F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("content") == F.col("missing")),
        "left_semi",
    )
    counted = (
        wanted.select("content", "text")
        .mapInArrow(_counter(name), "content string, n_tokens bigint")
        .groupBy("content")
        .agg(F.first("n_tokens").alias("n_tokens"))
        .select("content", F.lit(version).alias("tokenizer"), "n_tokens")
    )
    counted.write.mode("append").parquet(cache)
    # An append that was repeated after a failure leaves equal rows.
    counts = (
        spark.read.schema(CACHE_SCHEMA)
        .parquet(cache)
        .filter(F.col("tokenizer") == version)
        .groupBy("content")
        .agg(F.first("n_tokens").alias("n_tokens"))
    )
    # Copies of one content may be a third of all rows.
    return enrich_hot(narrow, counts, "content", ["n_tokens"]).select("doc_id", "n_bytes", "n_tokens")
