"""Which rows near-dedup by fingerprints keeps, by id and text."""

from __future__ import annotations

from projectmart.llm import near_copies, simhash


def test_one_row_of_each_component(frame):
    rows = [(None, "same text here"), (3, "same text here"), (3, "same text here"), (None, "other words")]
    rows += [(3, "a text of the same id but with words of its own"), (None, "one more text without any id"), (5, None), (None, "")]
    kept = simhash.one_of_each(frame(rows)).collect()
    assert len(kept) == 5
    assert {(r["doc_id"], r["text"]) for r in kept} == {
        (3, "same text here"),
        (None, "other words"),
        (3, "a text of the same id but with words of its own"),
        (None, "one more text without any id"),
        (5, None),
    }


def test_columns_named_like_helpers_stay(spark):
    rows = [(1, "same text here", "a", 1, "b", None), (2, "same text here", "c", 2, "d", 5), (3, "other words", "e", 3, "f", 6)]
    names = "doc_id bigint, text string, _row_key string, _keep bigint, key string, whole int"
    docs = spark.createDataFrame(rows, names)
    for keep in (simhash.one_of_each, near_copies.one_of_each):
        kept = keep(docs)
        assert kept.columns == docs.columns
        assert sorted(map(tuple, kept.collect())) == [rows[0], rows[2]]
