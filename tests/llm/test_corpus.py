"""The queries, and the pipeline against the plain versions of its stages."""

from __future__ import annotations

import brute
import corpus_pipeline
import pytest
from compare import connect, difference

from projectmart.llm import queries, tokens


@pytest.mark.parametrize("name", queries.SQL)
def test_query(spark, small, name):
    assert difference(queries.QUERIES[name](spark, small), connect(small), queries.SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_query_without_sql(spark, small, name):
    rows = queries.QUERIES[name](spark, small).collect()
    assert rows and not {"text", "url"} & set(rows[0].asDict())


def test_pipeline(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    kept, columns = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in kept.collect()}
        out = stage(spark, kept, small)
        assert out.columns == columns
        kept = spark.createDataFrame(out.collect(), docs.schema)
        after = {r["doc_id"]: r["text"] for r in kept.collect()}
        if name == "line dedup":
            want = brute.line_dedup(list(before.items()))
            assert {d: brute.sha(t) for d, t in after.items()} == {d: x[2] for d, x in want.items()}
            continue
        if name == "quality rules":
            good = {d for d, t in before.items() if not brute.quality_base(t)[-1]}
            assert set(after) <= good and len(after) >= 0.8 * len(good)
        elif name == "SimHash near-dedup":
            assert set(after) == brute.near_groups(list(before.items()))
        else:
            assert set(after) == {d for d, t in before.items() if not brute.contamination(t, bench)[-1]}
        assert all(before[d] == t for d, t in after.items())
    rows = corpus_pipeline.run(spark, small).collect()
    tokenizer = tokens.load(tokens.tokenizer_path("byte_bpe_50k.json"))
    brute.pieces_are_whole(rows, list(after.items()), tokenizer)
