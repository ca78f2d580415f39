"""Spelling variants against a comparison of all pairs of words."""

from __future__ import annotations

import itertools
import random
import string

import brute
import pytest

from projectmart.llm import queries, spelling


def as_dict(df):
    columns = ["form", "root", "n", "n_near", "form_n"]
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: tuple(r[c] for c in columns) for r in rows}


def near_of(spark, words, tmp_path):
    df = spark.createDataFrame([(w, 3 + i) for i, w in enumerate(words)], "word string, n bigint").repartition(3)
    return sorted((r["word"], r["near"]) for r in spelling.near_words(df, str(tmp_path)).collect())


def all_pairs(words):
    return sorted((a, b) for a, b in itertools.permutations(words, 2) if brute.one_edit(a, b))


def test_query(spark, small):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert as_dict(queries.QUERIES["op13_spelling"](spark, small)) == brute.spelling(brute.spelling_words(docs))


def test_spelling_variants(frame):
    draw, rows = random.Random(2), []
    for doc in range(150):
        words = draw.choices(["measure", "colour", "Étude", "theatre", "être", "running×on"], k=20)
        rows.append((doc, " ".join(words) + "\n" + "colour colOUR, tIny4tinyish"))
    rows += [(None, "colour " * 500 + "color " * 30), (None, "colour"), (3, None), (4, ""), (5, "Été")] + [rows[0]] * 3
    want = brute.spelling(brute.spelling_words(rows))
    assert as_dict(spelling.spelling_variants(frame(rows))) == want
    assert want["color"][1] == "colour" and len(want) > 10
    assert spelling.spelling_variants(frame([])).count() == 0
    assert spelling.spelling_variants(frame([(1, None), (2, "")])).count() == 0


@pytest.mark.parametrize(("most", "block"), [(512, 128), (8, 3), (1, 1)])
def test_near_words(spark, tmp_path, monkeypatch, most, block):
    monkeypatch.setattr(spelling, "MOST", most)
    monkeypatch.setattr(spelling, "BLOCK", block)
    draw = random.Random(5)
    words = {"".join(draw.choices("abé", k=draw.randint(5, 8))) for _ in range(300)}
    words |= {"aaaaa", "aaaaaa", "aaaaaaa", "abababab", "babababa", "ababababa"}
    words = sorted(words)
    assert near_of(spark, words, tmp_path) == all_pairs(words)


def test_a_crowd_that_agrees_outside_one_zone(spark, tmp_path):
    """All words share all but two letters; groups stay bounded and no pair is lost."""
    words = [f"a{a}{b}longsuffix" for a in string.ascii_lowercase for b in string.ascii_lowercase]
    words += [f"a{a}longsuffix" for a in string.ascii_lowercase]
    df = spark.createDataFrame([(w, 3) for w in words], "word string, n bigint")
    tables = spelling.groups(df, str(tmp_path / "g"))
    assert len(tables) > 1
    for table in tables:
        assert max((r["count"] for r in table.groupBy(*spelling.GROUP).count().collect()), default=0) <= spelling.MOST
    assert near_of(spark, words, tmp_path / "n") == all_pairs(words)


def test_very_long_words_and_texts(spark, frame, tmp_path):
    long = "ab" * 60_000
    words = [long, long[:-1], long + "a", long[:50_000] + "x" + long[50_001:], "short", "shirt"]
    assert near_of(spark, words, tmp_path) == all_pairs(words)
    rows = [(1, "measure measurs " * 700_000), (2, "measure, measure")]
    assert as_dict(spelling.spelling_variants(frame(rows))) == brute.spelling(brute.spelling_words(rows))


def test_chains_are_followed_to_the_end(spark, tmp_path):
    chain = [(f"w{i:03}", f"w{i + 1:03}") for i in range(40)] + [("other", "w010")]
    forms = spark.createDataFrame(chain, "word string, form string")
    got = {r["word"]: r["root"] for r in spelling.roots(forms, str(tmp_path)).collect()}
    assert got == {w: "w040" for w, _ in chain}
