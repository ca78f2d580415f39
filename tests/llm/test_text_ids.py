"""Ids of whole texts, put together block by block."""

from __future__ import annotations

import random

import brute
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from projectmart.llm import best_fit, packing, tokens

BYTE = "byte_bpe_50k.json"
SPECIAL = "x <|endoftext|>y<|startoftext|> <|ENDOFTEXT|> z"


def texts_of(corpus, odd):
    draw = random.Random(11)
    alphabet = "ab1 .\n\t '’é  s<|²\0A,"
    texts = [t or "" for _, t in corpus[:40] + odd] + [SPECIAL, "", " ", "a ", " a", ". a.", "日本語 です"]
    return texts + ["".join(draw.choices(alphabet, k=draw.randint(0, 40))) for _ in range(2000)]


def test_ids_are_those_of_the_library(corpus, odd):
    tokenizer = tokens.load(tokens.tokenizer_path(BYTE))
    texts = texts_of(corpus, odd)
    text_ids = tokens.TextIds(tokenizer)
    # A slice of a larger array, and once more from the memo.
    for array in (pa.array(["before", *texts, "after"]).slice(1, len(texts)), pa.array(texts, pa.large_string())):
        ids, ends = text_ids(array)
        low = 0
        for text, high in zip(texts, ends.tolist()):
            assert ids[low:high].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
            low = high
        assert low == len(ids)


def test_a_piece_goes_to_the_model_once_in_a_worker(monkeypatch):
    """Over blocks and tasks, whatever marks stand after a word or line breaks before it."""
    asked = []
    monkeypatch.setattr(tokens, "BLOCK_BYTES", 40)
    tokens.text_ids.cache_clear()
    encode = tokens.text_ids(BYTE)
    piece_ids = encode._pieces._encode
    monkeypatch.setattr(encode._pieces, "_encode", lambda pieces: (asked.extend(pieces), piece_ids(pieces))[1])
    texts = ["First seen word, seen word.\nThen seen", "word; seen. First! seen then:", None] * 5
    batch = pa.RecordBatch.from_arrays([pa.array(range(15)), pa.array(texts)], names=["doc_id", "text"])
    for _ in range(2):
        got = dict(tokens.document_ids([batch], BYTE, 0))
    tokens.text_ids.cache_clear()
    assert len(asked) == len(set(asked))
    tokenizer = tokens.load(tokens.tokenizer_path(BYTE))
    for doc, text in enumerate(texts):
        assert got[doc].tolist() == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("most", [1, 64])
def test_blocks_of_any_size_pack_the_same_pieces(corpus, odd, monkeypatch, most):
    rows = corpus[:20] + [(100_000 + d, t) for d, t in odd] + [(None, SPECIAL)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([d for d, _ in rows], pa.int64()), pa.array([t for _, t in rows])], names=["doc_id", "text"]
    )
    whole = [(d, x.tolist()) for d, x in tokens.document_ids([batch], BYTE, 0)]
    monkeypatch.setattr(tokens, "BLOCK_BYTES", most)
    assert [(d, x.tolist()) for d, x in tokens.document_ids([batch.slice(0, 0), batch], BYTE, 0)] == whole


def test_packers_give_whole_pieces(frame, corpus, odd):
    tokenizer = tokens.load(tokens.tokenizer_path(BYTE))
    rows = [(d, t) for d, t in corpus[:30]] + [(100_000 + d, t) for d, t in odd]
    brute.pieces_are_whole(packing.pack(frame(rows), BYTE).collect(), rows, tokenizer)
    out = best_fit.pack(frame(rows), BYTE, 64, 2)
    brute.best_fit_is_whole(out.collect(), rows, tokenizer, 64)
    assert out.filter(F.col("ids_crc32") < 0).count() == 0
