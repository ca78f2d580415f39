"""Stretches and regions of a shard: the same as a plain version, within bounded memory."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from projectmart.llm import arrays, recompression, repeats, suffix_dedup


def parsed(texts, width):
    offsets = np.cumsum([0, *map(len, texts)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    return suffix_dedup.ByteFinder(width).parse(data, offsets)


def peak(run):
    """The most bytes that ``run`` holds beyond what was held before."""
    tracemalloc.start()
    run()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most


@pytest.mark.parametrize("width", [1, 5, 30, 50])
def test_stretches_are_runs_of_equal_keys_inside_a_text(width, monkeypatch):
    draw = random.Random(width)
    for cached in (1, 7, 64, arrays.CACHED):
        monkeypatch.setattr(arrays, "CACHED", cached)
        monkeypatch.setattr(suffix_dedup, "CACHED", cached)
        for _ in range(30):
            sizes = draw.choices([0, 0, 1, width - 1, width, width + 1, 3 * width, 200], k=draw.randint(0, 8))
            texts = [bytes(draw.choices(b"ab", k=n)) for n in sizes]
            shard = parsed(texts, width)
            hashes = arrays.SpanHash()
            gram, want = min(suffix_dedup.GRAM, width), []
            for number, (text, low) in enumerate(zip(texts, shard.offsets.tolist())):
                one = np.frombuffer(text, np.uint8)
                sums = hashes.prefix(one)
                at = np.arange(max(0, len(one) - gram + 1))
                grams = hashes.spans(sums, at, at + gram).tolist() if len(at) else []
                keys = [min(grams[i : i + width - gram + 1]) for i in range(len(one) - width + 1)]
                for i, key in enumerate(keys):
                    if i and key == keys[i - 1]:
                        want[-1][2] += 1
                    else:
                        want.append([key, low + i, 1, number])
            got = [x.tolist() for x in shard.stretches()]
            assert [list(row) for row in zip(*got)] == want


def test_classes_of_spans_in_any_order():
    draw = random.Random(3)
    for _ in range(60):
        data = np.array(draw.choices([0, 97, 98], k=300), np.uint8)
        start = np.array([draw.randrange(250) for _ in range(draw.randint(1, 40))])
        length = np.array([draw.randint(1, 50) for _ in start])
        found = suffix_dedup.Regions(data, start, length).classes(start, length).tolist()
        strings = [data[s : s + n].tobytes() for s, n in zip(start.tolist(), length.tolist())]
        assert len(set(zip(found, strings))) == len(set(found)) == len(set(strings))


def test_regions_take_memory_for_what_they_hold():
    data = np.frombuffer(random.Random(5).randbytes(4 << 20), np.uint8)
    start, length = np.array([100, 3 << 20]), np.array([300, 300])
    assert peak(lambda: suffix_dedup.Regions(data, start, length).classes(start, length)) < len(data) // 4


def test_parsing_takes_few_bytes_for_each_of_a_text():
    text = random.Random(6).randbytes(2 << 20)
    shard = parsed([text], 50)
    assert peak(shard.stretches) < 20 * len(text)


@pytest.mark.parametrize("finder", [suffix_dedup.ByteFinder(), recompression.WordFinder()])
def test_keys_spread_evenly_over_buckets(finder):
    draw = random.Random(7)
    texts = [" ".join(f"w{draw.randrange(5000)}" for _ in range(2000)).encode() for _ in range(20)]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    shard = repeats.Shard(0, np.arange(20), data, offsets, finder, 5)
    sizes = [high - low for _, low, high in shard.key_cuts()]
    assert len(sizes) == 32 and max(sizes) < 1.5 * sum(sizes) / 32


def window_questions(draw, n_shards, n_names, values):
    """The table of a bucket, and (name, document) of each of its rows."""
    rows = []
    for _ in range(n_shards):
        names = np.unique(draw.integers(0, values, n_names, dtype=np.uint64))
        rows.append((names, draw.integers(-5, 1000, len(names))))
    columns = {
        "bucket": pa.array([3] * n_shards, pa.int32()),
        "shard": pa.array(range(n_shards), pa.int64()),
        "names": pa.array([names.tobytes() for names, _ in rows], pa.binary()),
        "extra": pa.array([b""] * n_shards, pa.binary()),
        "docs": pa.array([repeats._zip(docs) for _, docs in rows], pa.binary()),
    }
    return pa.table(columns), rows


@pytest.mark.parametrize("n_shards, n_names, values", [(1, 1, 9), (1, 50, 60), (7, 30, 40), (20, 9, 10**6)])
def test_windows_of_smaller_documents_are_answered(n_shards, n_names, values):
    table, rows = window_questions(np.random.default_rng(n_names), n_shards, n_names, values)
    least = {}
    for name, doc in [pair for names, docs in rows for pair in zip(names.tolist(), docs.tolist())]:
        least[name] = min(doc, least.get(name, doc))
    answer = repeats._answer_windows(table)
    assert answer["shard"].to_pylist() == list(range(n_shards))
    assert set(answer["bucket"].to_pylist()) == {3}
    for bits, (names, docs) in zip(answer["bits"].to_pylist(), rows):
        want = [least[name] < doc for name, doc in zip(names.tolist(), docs.tolist())]
        assert repeats._flags(bits, len(names)).tolist() == want


def test_answering_takes_few_bytes_for_each_window():
    table, rows = window_questions(np.random.default_rng(8), 40, 20_000, 2**40)
    assert peak(lambda: repeats._answer_windows(table)) < 50 * sum(len(names) for names, _ in rows)
