"""Bounded-space online best-fit packing."""

from __future__ import annotations

import random

import brute
from pyspark.sql import functions as F

from projectmart.llm import best_fit, queries, tokens

BYTE = "byte_bpe_50k.json"


def test_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    rows = queries.QUERIES["op11_best_fit"](spark, small).collect()
    tokenizer = tokens.load(tokens.tokenizer_path(BYTE))
    used = brute.best_fit_is_whole(rows, [tuple(r) for r in docs], tokenizer, 2048)
    assert used <= 1.03 * sum(r["length"] for r in rows) / 2048 + 1


def test_pack(frame, corpus, odd):
    tokenizer = tokens.load(tokens.tokenizer_path(BYTE))
    rows = corpus + [(100_000 + d, t) for d, t in odd]
    for capacity, most in ((2048, 256), (300, 3), (7, 1)):
        out = best_fit.pack(frame(rows), BYTE, capacity, most).collect()
        brute.best_fit_is_whole(out, rows, tokenizer, capacity)
    assert best_fit.pack(frame([]), BYTE).count() == 0


def test_repeated_rows_and_null_ids(frame):
    out = best_fit.pack(frame([(1, "a")] * 5 + [(None, None)] * 2), BYTE, capacity=4)
    assert out.count() == 7
    assert out.select("sequence_id", "offset").distinct().count() == 7
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 4").count() == 0
    # Seven pieces of five times two and twice one.
    assert out.agg(F.countDistinct("sequence_id")).first()[0] == 3


def plain_best_fit(lengths, capacity, most):
    """Open bins as a list, searched one by one."""
    bins, closed = [], []
    for n in lengths:
        fitting = [b for b in bins if capacity - sum(b) >= n]
        if fitting:
            held = min(fitting, key=lambda b: capacity - sum(b))
            bins.remove(held)
        else:
            held = []
        held = [*held, n]
        if sum(held) == capacity:
            closed.append(held)
            continue
        bins.append(held)
        if len(bins) > most:
            fullest = max(bins, key=sum)
            bins.remove(fullest)
            closed.append(fullest)
    return closed + bins


def test_bins_are_those_of_a_plain_search():
    draw = random.Random(11)
    for most in (1, 2, 5, 40):
        for _ in range(40):
            lengths = [draw.randint(1, 50) for _ in range(200)]
            bins, closed = best_fit.Bins(50, most), []
            for n in lengths:
                closed += bins.place(n, n)
                assert bins.n_open == sum(map(len, bins.by_free.values())) <= most
                assert bins.mask == sum(1 << f for f in bins.by_free)
            closed += bins.rest()
            want = plain_best_fit(lengths, 50, most)
            # Which of several bins with equal room is taken is free; how full they get is not.
            assert sorted(map(sum, closed)) == sorted(map(sum, want))


def test_only_long_documents_are_cut():
    assert best_fit.cut(2048, 2048) == [(0, 2048)]
    assert best_fit.cut(1, 2048) == [(0, 1)]
    assert best_fit.cut(5000, 2048) == [(0, 904), (904, 2048), (2952, 2048)]


def test_a_very_long_text(frame):
    text = "one two three " * 1_500_000
    rows = best_fit.pack(frame([(1, text), (2, "short")]), BYTE).collect()
    long = [r for r in rows if r["doc_id"] == 1]
    assert sum(r["length"] for r in long) == 4_500_002
    assert sorted({r["length"] for r in long if r["piece"]}) == [2048]
