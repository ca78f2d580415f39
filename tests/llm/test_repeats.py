"""Substring and window dedup."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest

from projectmart.llm import recompression, repeats, suffix_dedup


def removed(row):
    return sum(r["length"] for r in row["removed"])


def assert_bytes(frame, rows):
    out = suffix_dedup.dedup_substrings(frame(rows)).collect()
    got = {
        r["doc_id"]: (r["n_units"], removed(r), len(r["removed"]), brute.sha(bytes(r["kept"])))
        for r in out
    }
    assert got == brute.suffix_dedup(rows)


def assert_words(frame, rows):
    out = recompression.dedup_windows(frame(rows)).collect()
    got = {r["doc_id"]: (r["n_units"], removed(r), brute.sha(bytes(r["kept"]))) for r in out}
    assert got == brute.window_dedup(rows)


def passages(seed: int, words: list[str], n: int = 60):
    draw = random.Random(seed)
    base = [" ".join(draw.choices(words, k=draw.randint(5, 120))) for _ in range(12)]
    rows = []
    for doc in draw.sample(range(1000), n):
        parts = [draw.choice(base)[draw.randint(0, 80) :][: draw.randint(0, 400)] for _ in range(3)]
        rows.append((doc, "\n".join(parts)))
    return rows


@pytest.mark.parametrize("words", [["a", "b"], ["the", "of", "éa", "x"], [f"w{i}" for i in range(200)]])
def test_repeats_against_brute_force(frame, monkeypatch, words):
    # Many shards and buckets for few rows.
    monkeypatch.setattr(repeats, "SHARD_BYTES", 2000)
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 3000)
    rows = passages(len(words), words)
    assert_bytes(frame, rows)
    assert_words(frame, rows)


def test_repeats_on_the_tables(frame, corpus, odd):
    rows = corpus[:80] + [(100_000 + d, t) for d, t in odd]
    assert_bytes(frame, rows)
    assert_words(frame, rows)


@pytest.mark.parametrize("dedup", [suffix_dedup.dedup_substrings, recompression.dedup_windows])
def test_repeats_odd_rows(frame, dedup):
    text = " ".join(f"word{i}" for i in range(40))
    out = dedup(frame([(1, text), (1, text), (None, text), (2, text)])).collect()
    whole = {r["doc_id"]: r["n_units"] - removed(r) for r in out}
    # The null id is the smallest and keeps its text; equal ids do not remove each other.
    assert len(out) == 4 and whole[None] > 0 and whole[1] == whole[2] == 0
    out = dedup(frame([(1, text), (1, text)])).collect()
    assert all(removed(r) == 0 for r in out)
    assert dedup(frame([])).count() == 0


def test_suffix_array_and_common_prefixes():
    draw = random.Random(2)
    for _ in range(300):
        text = bytes(draw.choices(b"ab\0", k=draw.randint(1, 80)))
        data = np.frombuffer(text, np.uint8)
        eight = suffix_dedup.words_of_eight(data)
        order, rank = suffix_dedup.suffix_array(data, eight)
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        assert rank[order].tolist() == list(range(len(text)))
        prefixes = suffix_dedup.common_prefixes(data, eight, order)
        for k in range(1, len(text)):
            a, b = text[order[k] :], text[order[k - 1] :]
            n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert prefixes[k] == n


def test_equal_windows_have_equal_keys():
    draw = random.Random(3)
    words = ["a", "b", "the", "of"]
    window = " ".join(draw.choices(words, k=13))
    texts = [
        " ".join([*draw.choices(words, k=draw.randint(0, 9)), window, *draw.choices(words, k=draw.randint(0, 9))])
        for _ in range(300)
    ]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t) for t in texts)])
    parsed = recompression.WordFinder().parse(data, offsets)
    key, start, length, _ = parsed.stretches()
    names, keys = parsed.window_names(np.repeat(start, length) + np.concatenate([np.arange(n) for n in length])), np.repeat(key, length)
    by_name = {}
    for name, k in zip(names.tolist(), keys.tolist()):
        assert by_name.setdefault(name, k) == k
