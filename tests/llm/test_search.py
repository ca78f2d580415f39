"""Decontamination, SimHash and personal data."""

from __future__ import annotations

import pickle
import random
import time

import brute
import numpy as np
import pytest

from projectmart.llm import components, decontamination, pii, simhash

ITEM = "Zero one two THREE four five six seven eight nine ten eleven"


def contaminated(frame, spark, rows, items):
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    out = decontamination.find_contamination(frame(rows), bench, ["doc_id", "n_words"])
    for r in out.collect():
        assert r["c_n_words"] == 7
        found = brute.sha(",".join(r["items"]))
        hit = len(r["hit_words"])
        yield r["c_doc_id"], (r["n_words"], hit, len(r["items"]), found, hit > 0)


@pytest.mark.parametrize(("block", "segment"), [(decontamination.BLOCK_WORDS, decontamination.SEGMENT), (9, 2)])
def test_decontamination(frame, spark, monkeypatch, block, segment):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", block)
    monkeypatch.setattr(decontamination, "SEGMENT", segment)
    items = [(1, ITEM), (2, ITEM), (2, "é ü"), (3, "single"), (4, None), (5, "?!"), (None, "never found")]
    rows = [
        (1, f"before; {ITEM.lower()}! after"),
        (2, ITEM.replace("five", "six")),
        (3, "É ü"),
        (4, "é-ü, Single single"),
        (5, None),
        (6, ""),
        (7, "never found"),
        (8, " ".join(["zero"] * 3000) + " " + ITEM),
    ]
    got = dict(contaminated(frame, spark, rows, items))
    # The words of items without an id are hits, but add no id to the list.
    with_id = [x for x in items if x[0] is not None]
    for doc, text in rows:
        every, named = brute.contamination(text, items), brute.contamination(text, with_id)
        assert got[doc] == (every[0], every[1], named[2], named[3], every[4])
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    clean = decontamination.clean_documents(frame(rows), bench)
    assert {r["doc_id"] for r in clean.collect()} == {d for d, x in got.items() if not x[-1]}
    assert clean.columns == frame(rows).columns
    empty = bench.limit(0)
    assert decontamination.clean_documents(frame(rows), empty).count() == len(rows)
    assert decontamination.clean_documents(frame([]), bench).count() == 0


def test_a_long_benchmark_is_built_in_time_and_searched_in_blocks(frame, spark):
    draw = random.Random(12)
    words = [f"w{i}" for i in range(30_000)]
    items = [(i, " ".join(draw.choices(words, k=4000))) for i in range(95)]
    assert 1_800_000 < sum(len(t) for _, t in items) < 2_600_000
    bench = spark.createDataFrame(items, "item_id bigint, text string").repartition(4)
    began = time.monotonic()
    tables = decontamination.segments(bench).collect()
    names, patterns = decontamination.build_patterns([(r["item_id"], r["words"].encode()) for r in tables])
    assert len(names) == 95 and len(patterns) == 1 and len(patterns[0].keys) > 370_000
    assert len(pickle.dumps(patterns)) < 60_000_000
    assert time.monotonic() - began < 60
    # Two passages of one document lie in different blocks.
    rows = [(k, " ".join(draw.choices(words, k=50))) for k in range(20)]
    rows += [(100 + k, f"before {' '.join(items[k][1].split()[100:110])} between {' '.join(items[-1 - k][1].split()[3000:3012])} after") for k in range(5)]
    got = dict(contaminated(frame, spark, rows, items))
    assert {d: x[:2] for d, x in got.items() if x[-1]} == {100 + k: (25, 22) for k in range(5)}
    assert all(x[2] == 2 for d, x in got.items() if d >= 100)


def test_windows_of_one_hash_are_told_apart(frame, spark, monkeypatch):
    """Every window has the same hash: only the words decide."""
    items = [(1, "a b"), (2, "b c"), (3, "c a"), (1, "x " * 12), (4, "y " * 10)]
    rows = [(1, "a b c"), (2, "b a"), (3, "y " * 11), (4, "x " * 9), (5, "c a b")]
    monkeypatch.setattr(decontamination, "windows_of", lambda h: np.zeros(len(h), np.uint64))
    monkeypatch.setattr(decontamination, "windows", lambda w, n: np.zeros(max(0, len(w) - n + 1), np.uint64))
    prepared = [(str(i), t.strip().encode()) for i, t in items]
    names, tables = decontamination.build_patterns(prepared)
    data = np.frombuffer("".join(t for _, t in rows).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t) for _, t in rows)])
    _, in_text, hit, found = decontamination._search(tables, data, offsets, decontamination.SpanHash())
    for k, (_, text) in enumerate(rows):
        want = brute.contamination(text, items)
        assert (int((in_text == k).sum()), len({i for t, i in found if t == k})) == want[1:3]


def test_a_very_long_document(frame, spark):
    text = "filler words go on " * 1_000_000 + ITEM
    got = dict(contaminated(frame, spark, [(1, text), (2, "short")], [(1, ITEM)]))
    assert got[1][:3] == (4_000_012, 12, 1) and not got[2][-1]


def test_fingerprints(odd, corpus):
    for _, text in [*odd, *corpus[:60]]:
        assert simhash.fingerprint((text or "").encode()) == brute.fingerprint(text)


def test_keys_of_close_fingerprints_meet():
    draw, golay = random.Random(6), simhash.Golay()
    assert sorted(set(golay.count.tolist())) == [1, 6]
    for bits in range(4):
        a = np.array([draw.getrandbits(64) for _ in range(500)], np.uint64)
        flips = [sum(1 << b for b in draw.sample(range(64), bits)) for _ in a]
        b = a ^ np.array(flips, np.uint64)
        keys = []
        for x in (a, b):
            found, owners = simhash.golay_keys(x.view(np.int64), golay)
            each = {}
            for k, o in zip(found.tolist(), owners.tolist()):
                each.setdefault(o, set()).add(k)
            keys.append([each[o] for o in x.view(np.int64).tolist()])
        assert all(x & y for x, y in zip(*keys))


def test_near_duplicates(frame, corpus, odd):
    rows = corpus + [(100_000 + d, t) for d, t in odd]
    out = simhash.near_duplicates(frame(rows)).collect()
    got = {r["doc_id"]: (f"{r['fingerprint'] % 2**64:016x}", r["component_id"]) for r in out}
    assert got == brute.components(rows)
    kept = simhash.one_of_each(frame(rows))
    assert {r["doc_id"] for r in kept.collect()} == {c for _, c in got.values()}
    assert kept.columns == frame(rows).columns


def test_chains_and_crowds_of_fingerprints(spark):
    draw = random.Random(9)
    center = draw.getrandbits(64)
    crowd = {center ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(i)}
    chain, at = [], draw.getrandbits(64)
    for _ in range(40):
        at ^= sum(1 << b for b in draw.sample(range(64), 3))
        chain.append(at)
    alone = [draw.getrandbits(64) for _ in range(50)]
    prints = [*crowd, *chain, *alone]
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(p,) for p in signed], "fingerprint bigint").repartition(5)
    links = simhash.links(frame)
    # Far fewer than all pairs of the crowd.
    assert links.count() < 60 * len(prints)
    import tempfile

    roots = components.connected(links, tempfile.mkdtemp()).collect()
    of = {r["node"]: r["root"] for r in roots}
    parts = [{of.get(p, p) for p in np.array(list(x), np.uint64).view(np.int64).tolist()} for x in (crowd, chain)]
    assert len(parts[0]) == 1 and len(parts[1]) == 1 and parts[0] != parts[1]
    assert len({of.get(p, p) for p in signed}) == 2 + len(set(alone))


def test_a_crowd_of_one_key_ends():
    draw, center = np.random.default_rng(5), np.uint64(0x0123456789ABCDEF)
    # One hundred thousand fingerprints that differ in the middle segment only, and chains among them.
    middle = draw.integers(0, 1 << 23, 100_000, dtype=np.uint64) << np.uint64(23)
    prints = np.unique((center & ~(np.uint64((1 << 23) - 1) << np.uint64(23))) | middle)
    began = time.monotonic()
    links = simhash.grown_links(prints.view(np.int64))
    assert time.monotonic() - began < 60
    some = prints[:: len(prints) // 40]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    for a in some:
        for b in prints[np.bitwise_count(prints ^ a) <= 3].view(np.int64).tolist():
            assert find(b) == find(int(a.view(np.int64)))


def test_split_runs_have_the_groups_of_whole_ones(monkeypatch):
    draw = random.Random(13)
    prints = {draw.getrandbits(14) | (draw.getrandbits(4) << 40) for _ in range(1500)}
    signed = np.array(sorted(prints), np.int64)

    def parts(links):
        of = {int(p): int(p) for p in signed}

        def find(x):
            while of[x] != x:
                x = of[x]
            return x

        for a, b in links:
            of[find(a)] = find(b)
        groups = {}
        for p in of:
            groups.setdefault(find(p), set()).add(p)
        return sorted(map(sorted, groups.values()))

    whole = parts(simhash._grown(signed))
    monkeypatch.setattr(simhash, "LONG_RUN", 20)
    assert parts(simhash.grown_links(signed)) == whole


def test_near_duplicates_odd_rows(frame):
    rows = [(None, "same text here"), (3, "same text here"), (3, "same text here"), (None, "other words")]
    out = simhash.near_duplicates(frame(rows)).collect()
    assert sorted(str(r["component_id"]) for r in out) == ["3", "3", "3", "None"]
    assert simhash.one_of_each(frame(rows)).count() == 2
    assert simhash.near_duplicates(frame([])).count() == 0


def test_personal_data_base(frame, corpus, odd):
    rows = corpus + [(100_000 + d, t) for d, t in odd]
    texts = dict(rows)
    out = pii.find_personal_data(frame(rows)).collect()
    assert len(out) == len(rows)
    for r in out:
        want = brute.personal_data(texts[r["doc_id"]])
        assert r["base_spans"] == ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        for kind in pii.KINDS:
            assert r[f"n_{kind}"] == sum(k == kind for k, _, _ in want)
    assert pii.find_personal_data(frame([])).count() == 0


def test_personal_data_base_on_random_texts():
    draw = random.Random(5)
    for _ in range(20_000):
        text = "".join(draw.choices("a.@1+ -(9%_x0@..\né", k=draw.randint(0, 40)))
        found = pii.detect(text)
        assert [(k, *s) for k in pii.KINDS for s in found[k]] == brute.personal_data(text)


@pytest.mark.parametrize(
    ("kind", "hidden"),
    [
        ("email", "jane dot doe at mail dot example dot com"),
        ("email", "jane(at)example(dot)com"),
        ("email", "jane [AT] example [DOT] com"),
        ("email", "j\u0430ne@ex\u0430mple.com"),
        ("email", "\uff4aane\uff20example\uff0ecom"),
        ("email", "jane@exam\u200bple.com"),
        ("email", "jane&#64;example&#46;com"),
        ("email", "jane @ example dot com"),
        ("phone", "plus one four one five five five five two six seven one"),
        ("phone", "+1 (\uff14\uff11\uff15) 555-2671"),
        ("ip", "192[.]168[.]1[.]17"),
        ("ip", "one nine two dot one six eight dot one dot one seven"),
        ("card", "\uff14\uff11\uff11\uff11 1111 1111 \uff11\uff11\uff11\uff11"),
        ("card", "four one one one one one one one one one one one one one one one"),
    ],
)
def test_disguises_map_back_to_the_source(kind, hidden):
    text = f"Été: reach us, {hidden} - or not, 10.0.0.1"
    base, spans = pii.all_spans(text)
    start = text.index(hidden)
    assert (start, start + len(hidden)) in spans[kind]
    assert all(set(base[k]) <= set(spans[k]) for k in pii.KINDS)


def test_clean_texts_have_no_spans_added(corpus):
    for _, text in corpus:
        base, spans = pii.all_spans(text or "")
        assert base == spans
    for text in ("he is at home. The dot on it", "one two three of one", "a [at] b", "(dot)"):
        assert not any(pii.all_spans(text)[1].values())
