"""Benchmark items without an id: their words are hits, and there is no id to list."""

from __future__ import annotations

import brute
import pytest
from compare import connect, difference
from test_search import ITEM, contaminated

from projectmart.llm import decontamination, queries


@pytest.mark.parametrize("block", [decontamination.BLOCK_BYTES, 60])
def test_items_without_id(frame, spark, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
    items = [(None, ITEM), (None, "lost words here"), (1, "found words"), (2, "shared words"), (None, "shared words")]
    rows = [(1, f"before {ITEM} after"), (2, "lost words here"), (3, "found words"), (4, "Shared, words!"), (5, "clean")]
    got = dict(contaminated(frame, spark, rows, items))
    nameless = [(i, t) for i, t in items if i is None]
    for doc, text in rows:
        n_words, n_hit, _, _, hit = brute.contamination(text, items)
        listed = brute.contamination(text, [x for x in items if x not in nameless])
        assert got[doc] == (n_words, n_hit, *listed[2:4], hit)
    assert [got[d][-1] for d in range(1, 6)] == [True, True, True, True, False]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    assert [r["doc_id"] for r in decontamination.clean_documents(frame(rows), bench).collect()] == [5]


def test_query_agrees_with_sql(frame, spark, tmp_path):
    items = [(None, ITEM), (None, "lost words"), (1, "found words"), (None, "found words")]
    rows = [(1, f"before {ITEM} after lost words"), (2, "found words"), (3, "clean")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for name, table in (("documents", frame(rows)), ("benchmark", bench)):
        table.toPandas().to_parquet(tmp_path / f"{name}.parquet")
    got = queries.QUERIES["op10_decontamination"](spark, str(tmp_path))
    sql = queries.SQL["op10_decontamination"]
    assert difference(got, connect(str(tmp_path)), sql) is None
