"""Token counts and packing."""

from __future__ import annotations

import random

import brute
from pyspark.sql import functions as F

from projectmart.llm import packing, token_counts, tokens

WORD, BYTE = "word_bpe_49k.json", "byte_bpe_50k.json"
SPECIAL = "x <|endoftext|>y<|startoftext|> <|ENDOFTEXT|> z"


def test_chunks_have_the_tokens_of_the_whole(corpus, odd):
    word, byte = (tokens.load(tokens.tokenizer_path(n)) for n in (WORD, BYTE))
    counts = tokens.Memo(tokens.chunk_counts(word))
    ids = tokens.Memo(tokens.ChunkIds(byte))
    draw = random.Random(4)
    texts = [t or "" for _, t in corpus[:40] + odd] + [SPECIAL]
    texts += ["".join(draw.choices("ab1 .\n\t '’é\u00a0\u2003s<|²", k=draw.randint(0, 30))) for _ in range(2000)]
    for text in texts:
        chunks = tokens.white_chunks(text.encode())
        got = sum(map(counts.values([chunks]).__getitem__, chunks))
        assert got == len(word.encode(text, add_special_tokens=False)), repr(text)
        chunks = tokens.space_chunks(text)
        got = b"".join(map(ids.values([chunks]).__getitem__, chunks))
        assert got == tokens.id_bytes(byte.encode(text, add_special_tokens=False).ids), repr(text)


def test_token_counts_and_cache(spark, frame, odd, tmp_path):
    cache = str(tmp_path / "cache")
    rows = odd + [(40, SPECIAL), (40, SPECIAL), (None, "a  b"), (41, " a\tb ")]
    tokenizer = tokens.load(tokens.tokenizer_path(WORD))

    def want(rows):
        return sorted(
            (-1 if d is None else d, len((t or "").encode()), len(tokenizer.encode(t or "")))
            for d, t in rows
        )

    def got(rows):
        out = token_counts.token_counts(frame(rows), WORD, cache)
        return sorted((-1 if r[0] is None else r[0], r[1], r[2]) for r in out.collect())

    assert got(rows) == want(rows)
    stored = spark.read.parquet(cache)
    first = stored.count()
    # One entry per different content: three empty ones, two copies and two spellings of "a b".
    assert first == stored.select("content").distinct().count() == len(rows) - 5
    # A second run encodes only what is new.
    assert got([*rows, (50, "new text")]) == want([*rows, (50, "new text")])
    assert spark.read.parquet(cache).count() == first + 1
    assert got([]) == []


def test_packing(frame, corpus, odd):
    tokenizer = tokens.load(tokens.tokenizer_path(BYTE))
    rows = corpus + [(100_000 + d, t) for d, t in odd]
    out = packing.pack(frame(rows), BYTE).collect()
    padding = brute.pieces_are_whole(out, rows, tokenizer)
    assert padding <= 0.02 * sum(r["length"] for r in out)
    assert packing.pack(frame([]), BYTE).count() == 0


def test_packing_of_repeated_rows(frame):
    out = packing.pack(frame([(1, "a")] * 5 + [(None, None)]), BYTE, capacity=4)
    assert out.count() == 6
    assert out.select("sequence_id", "offset").distinct().count() == 6
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 4").count() == 0


def test_shortest_pack_first_uses_every_piece_once():
    draw = random.Random(8)
    for _ in range(50):
        histogram = {draw.randint(1, 64): draw.randint(1, 500) for _ in range(30)}
        patterns = packing.shortest_pack_first(histogram, 64)
        used = {}
        for lengths, count in patterns:
            assert sum(lengths) <= 64
            for length in lengths:
                used[length] = used.get(length, 0) + count
        assert used == histogram and len(patterns) <= 3 * 64
