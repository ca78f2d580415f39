"""Ranked search against a search that scores every document."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest

from projectmart.llm import ranked_search

ITEMS = "item_id bigint, text string, score bigint, key string"


def found(spark, frame, rows, items, **options):
    asked = spark.createDataFrame([(i, t, 5, "x") for i, t in items], ITEMS)
    out = ranked_search.search(frame(rows), asked, **options)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def plain(rows, items, k=10):
    return sorted(brute.ranked_search(rows, items, k), key=str)


@pytest.mark.parametrize("shard", [ranked_search.SHARD_BYTES, 2000])
def test_search(spark, frame, corpus, odd, shard, monkeypatch):
    monkeypatch.setattr(ranked_search, "SHARD_BYTES", shard)
    monkeypatch.setattr(ranked_search, "BLOCK_TERMS", 60)
    rows = corpus[:80] + [(100_000 + d, t) for d, t in odd]
    items = [(d, (t or "")[:400]) for d, t in corpus[80:95]]
    items += [(1000, None), (1001, ""), (1002, "?!"), (1003, "nowhere_to_be_found"), (1004, "a A a B"), (1005, "ÉÀ É")]
    assert found(spark, frame, rows, items) == plain(rows, items)
    assert found(spark, frame, rows, items, k=3) == plain(rows, items, 3)


def test_ties_null_ids_and_repeated_rows(spark, frame):
    rows = [(d, "same text here") for d in range(30, 0, -1)] + [(None, "same text here")] * 3
    rows += [(7, "same text here"), (50, "other words"), (None, None), (51, "")]
    items = [(1, "same here"), (1, "same here"), (None, "other"), (2, "text text same")]
    assert found(spark, frame, rows, items) == plain(rows, items)
    assert found(spark, frame, rows[28:], items, k=40) == plain(rows[28:], items, 40)


def test_empty_tables(spark, frame):
    assert found(spark, frame, [], [(1, "a")]) == []
    assert found(spark, frame, [(1, None)], [(1, "a")]) == []
    assert found(spark, frame, [(1, "a b")], []) == []


def test_long_texts_are_read_whole(spark, frame, monkeypatch):
    monkeypatch.setattr(ranked_search, "SLICE_BYTES", 64)
    rows = [(1, "alpha beta " * 50 + "x" * 300 + " gamma"), (2, "beta gamma"), (3, "delta")]
    items = [(1, "gamma"), (2, "beta beta delta"), (3, "x" * 300)]
    assert found(spark, frame, rows, items) == plain(rows, items)


def test_a_very_long_text(spark, frame):
    rows = [(1, "alpha beta " * 1_900_000 + "gamma"), (2, "beta gamma"), (3, "delta")]
    got = found(spark, frame, rows, [(1, "gamma alpha")])
    assert got == plain(rows, [(1, "gamma alpha")])


def test_no_accumulator_after_the_bounds_fall(monkeypatch):
    """Lists of common terms are only looked up once the rare ones decide."""
    draw, n = random.Random(3), 4000
    texts = [" ".join(draw.choices("abcdefgh", k=20)) for _ in range(n)]
    for i in range(0, n, 200):
        texts[i] += " rare rare rare unique"
    shard = ranked_search._Shard()
    for i, t in enumerate(texts):
        shard.add(i, t.encode())
    row = shard.row().to_pylist()[0]
    numbers = {t: i for i, t in enumerate([*"abcdefgh", "rare", "unique"])}
    postings = ranked_search._Postings(row, numbers, n, row["n_terms"])
    weights = [(numbers["rare"], 5000), (numbers["unique"], 5000), (numbers["a"], 80), (numbers["b"], 70)]
    docs, sums = ranked_search.best(weights, postings, 10)
    # Accumulators of the shard hold the rare terms only.
    assert np.count_nonzero(postings.scores) == n // 200
    every = np.zeros(n, np.int64)
    for number, weight in weights:
        at, parts, _ = postings.of(number)
        every[at] += weight * parts
    order = np.lexsort((np.arange(n), -every))[:10]
    assert docs.tolist() == order.tolist() and sums.tolist() == every[order].tolist()
