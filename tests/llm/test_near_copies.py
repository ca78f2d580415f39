"""Near copies against the similarity of all pairs."""

from __future__ import annotations

import random
import time

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest

from projectmart.llm import near_copies, simhash


def words_of(text):
    return (text or "").lower().split()


def shingle_set(text):
    w = words_of(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def kept_by_brute_force(rows):
    """(doc_id, text) of the smallest row of each group, all pairs compared."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 5 * len(a & b) >= 4 * len(a | b):
                parent[find(i)] = find(j)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(find(i), set()).add((doc is None, doc or 0))
    return sorted(min(g) for g in groups.values())


def ids(kept):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect())


def edited(draw, words, edits):
    out = list(words)
    for i in draw.sample(range(len(out)), edits):
        out[i] = f"new{draw.randrange(10**6)}"
    return " ".join(out)


@pytest.fixture(scope="module")
def copies():
    """Texts with copies of all similarities, and many copies of one text, some linked over others."""
    draw, rows = random.Random(3), []
    for size in (5, 9, 30, 60, 200, 900):
        for edits in (1, 2, 3, 5, 8, 20):
            base = [f"w{draw.randrange(10**5)}" for _ in range(size)]
            rows += [" ".join(base).upper(), edited(draw, base, min(edits, size))]
    base = [f"c{i}" for i in range(150)]
    rows += [edited(draw, base, draw.choice((1, 2, 3, 4))) for _ in range(90)]
    rows += ["", None, "a b", "A  b", "a c"]
    draw.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("common", [1, 8])
def test_kept_rows(frame, copies, monkeypatch, common):
    monkeypatch.setattr(near_copies, "SAMPLED", 1 if common == 1 else 16)
    monkeypatch.setattr(near_copies, "COMMON", common)
    kept = corpus_pipeline.near_dedup_stage(None, frame(copies), "")
    assert ids(kept) == kept_by_brute_force(copies)
    assert kept.columns == frame(copies).columns


def test_simhash_finds_the_nearest(frame, copies, monkeypatch):
    """Fingerprints within three bits are candidates, and texts that only they find are linked."""
    draw = random.Random(5)
    base = [f"t{i}" for i in range(2000)]
    rows = copies[:40] + [(1000 + i, edited(draw, base, 1)) for i in range(6)]
    prints = {d: simhash.majority(near_copies.shingles((t or "").encode())) for d, t in rows}
    assert simhash.majority(np.zeros(0, np.uint64)) == 0
    found, made = [], near_copies.simhash_pairs

    def seen(different, folder):
        pairs = made(different, folder)
        name = {r["name"]: r["first"]["doc_id"] for r in different.collect()}
        found.extend((name[r["a"]], name[r["b"]]) for r in pairs.collect())
        return pairs

    monkeypatch.setattr(near_copies, "simhash_pairs", seen)
    assert ids(corpus_pipeline.near_dedup_stage(None, frame(rows), "")) == kept_by_brute_force(rows)
    near = {(a, b) for a in range(1000, 1006) for b in range(1000, a) if (prints[a] ^ prints[b]).bit_count() <= 3}
    # Texts of one fingerprint are compared with one of them.
    assert near and {d for pair in near for d in pair} <= {d for pair in found for d in pair}
    # Without keys of shingles, SimHash alone links them.
    monkeypatch.setattr(near_copies, "prefix", lambda found, common: found[:0])
    kept = corpus_pipeline.near_dedup_stage(None, frame(rows[-6:]), "")
    assert kept.count() < 6


def test_kept_rows_of_the_corpus(frame, corpus):
    assert ids(near_copies.one_of_each(frame(corpus))) == kept_by_brute_force(corpus)


def test_rows_without_id_and_of_one_id(frame):
    rows = [(None, "same text here"), (3, "same text here"), (3, "same text here"), (None, "other words"), (3, "third")]
    kept = near_copies.one_of_each(frame(rows)).collect()
    assert {(r["doc_id"], r["text"]) for r in kept} == {(3, "same text here"), (None, "other words"), (3, "third")}
    assert len(kept) == 3
    assert near_copies.one_of_each(frame([])).count() == 0


def test_filters_lose_no_similar_pair():
    draw = random.Random(4)
    for _ in range(400):
        n = draw.choice((5, 40, 300, 1200))
        base = [str(draw.randrange(300)) for _ in range(n)]
        x, y = (near_copies.shingles(t.encode()) for t in (" ".join(base), edited(draw, base, draw.randrange(1 + n // 20))))
        common = np.sort(np.array(draw.sample(x.tolist(), len(x) // 3), np.uint64))
        if near_copies.similar(x, y):
            assert near_copies.may_be_similar(len(x), near_copies.parity(x), len(y), near_copies.parity(y))
            assert set(near_copies.prefix(x, common).tolist()) & set(near_copies.prefix(y, common).tolist())


def test_parity_words_lose_no_similar_pair():
    draw, checked = random.Random(6), 0
    for _ in range(200):
        n = draw.choice((5, 40, 300, 1200))
        base = [str(draw.randrange(300)) for _ in range(n)]
        x, y = (near_copies.shingles(t.encode()) for t in (" ".join(base), edited(draw, base, draw.randrange(1 + n // 20))))
        sets = pa.RecordBatch.from_arrays(
            [pa.array([1, 2]), pa.array([x.tobytes(), y.tobytes()], pa.binary())], names=["name", "set"]
        )
        (found,) = near_copies._parity_words(iter([sets]))
        first, second = ([r[f"p{i}"] for i in range(near_copies.PARITY_WORDS)] for r in found.to_pylist())
        differ = sum(((a ^ b) & (2**64 - 1)).bit_count() for a, b in zip(first, second))
        assert differ <= len(np.setxor1d(x, y))
        if near_copies.similar(x, y):
            checked += 1
            assert 9 * differ <= len(x) + len(y)
    assert checked > 50


def test_boilerplate_below_the_similarity_makes_no_pairs(spark, frame, tmp_path):
    """Five thousand texts that share 85 of 100 shingles: similarity 0.74, nothing to link."""
    shared = [f"s{i}" for i in range(89)]
    rows = [(d, " ".join([*(f"d{d}x{i}" for i in range(15)), *shared])) for d in range(5000)]
    began = time.monotonic()
    different, roots = near_copies.near_copies(frame(rows), str(tmp_path))
    assert different.count() == 5000 and roots.count() == 0
    assert time.monotonic() - began < 60
    # Scratch tables are gone, what the result reads is not.
    left = {p.name for p in tmp_path.iterdir()}
    assert "different" in left and not left & {"keyed", "met", "few", "sets", "verified"}


def test_boilerplate_with_copies_inside(frame, monkeypatch):
    draw, shared = random.Random(8), [f"s{i}" for i in range(89)]
    rows = []
    for d in range(150):
        own = [f"d{d}x{i}" for i in range(15)]
        rows.append(" ".join([*own, *shared]))
        if d % 3 == 0:
            rows.append(" ".join([*own[:-1], "other", *shared]))
        if d % 5 == 0:
            rows.append(" ".join([*own[:2], *shared, *own[2:6]]))
    rows = list(enumerate(rows))
    draw.shuffle(rows)
    for small in (32, 2):
        monkeypatch.setattr(near_copies, "SMALL_KEY", small)
        monkeypatch.setattr(near_copies, "SAMPLED", 1)
        assert ids(near_copies.one_of_each(frame(rows))) == kept_by_brute_force(rows)


def test_keys_cut_by_batches(monkeypatch):
    """Keys of many rows, whichever batches they come in, give the rows and pairs of one batch."""
    draw = np.random.default_rng(3)
    key = np.sort(draw.integers(0, 40, 3000))
    n = np.full(3000, 100)
    columns = [key, n, draw.integers(0, 20, 3000), draw.permutation(3000)]
    names = ["key", "n", "place", "name"]

    def met(size):
        cuts = [pa.RecordBatch.from_arrays([pa.array(c[i : i + size]) for c in columns], names=names) for i in range(0, 3000, size)]
        rows = [tuple(r.values()) for b in near_copies._met(iter(cuts)) for r in b.to_pylist()]
        return sorted(rows, key=str)

    for small in (10, 70, 80, 5000):
        monkeypatch.setattr(near_copies, "SMALL_KEY", small)
        assert met(3000) == met(17) == met(1)
