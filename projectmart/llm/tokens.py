"""Tokens of whole texts by way of their chunks.

The given tokenizers never join what stands on both sides of certain spaces, so a text can be cut
there, and equal chunks have equal tokens. Chunks, or the words they consist of, are encoded by the
library once for each task (for ids: for each Python worker) as long as they are in a bounded memo;
the ids and counts are those of the whole text. For ids, Arrow cuts blocks of texts and finds their
different chunks and words.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from projectmart.llm.arrays import blocks

# Chunks kept by a task, and the longest chunk that is kept.
MEMO_CHUNKS = 800_000
MEMO_CHARS = 64
# Texts whose ids are put together at a time; a longer text is a block of its own.
BLOCK_BYTES = 4 << 20


def load(path: str):
    """The tokenizer of a file, encoding in the calling thread only."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Memo:
    """``encode`` of each chunk, for the chunks of one block of texts and, up to the bound, those of
    earlier blocks."""

    def __init__(self, encode: Callable[[list], Iterable]):
        self._encode = encode
        self._known: dict = {}

    def values(self, lists: Iterable[Iterable]) -> dict:
        known = self._known
        if len(known) > MEMO_CHUNKS:
            known.clear()
        new = list(set().union(*lists).difference(known))
        if not new:
            return known
        found = dict(zip(new, self._encode(new)))
        if all(len(c) <= MEMO_CHARS for c in new):
            known.update(found)
            return known
        known.update((c, v) for c, v in found.items() if len(c) <= MEMO_CHARS)
        return {**known, **found}


def encodings(tokenizer, chunks: list[str]) -> Iterator:
    for low in range(0, len(chunks), 4096):
        part = chunks[low : low + 4096]
        yield from tokenizer.encode_batch_fast(part, add_special_tokens=False)


def chunk_counts(tokenizer) -> Callable[[list[bytes]], Iterable[int]]:
    """Numbers of tokens of chunks."""
    return lambda chunks: map(len, encodings(tokenizer, [c.decode() for c in chunks]))


_FORMATS = [f"<{n}I" for n in range(33)]


def id_bytes(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    few = len(ids) < len(_FORMATS)
    return struct.pack(_FORMATS[len(ids)] if few else f"<{len(ids)}I", *ids)


def _byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for
    themselves, the others from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b if b in plain else next(rest)) for b in range(256)}


# Latin letters and common marks. In a chunk of lines of such words, the pattern of the tokenizer
# takes each word (with its space), each run of marks and each line break by itself.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_WORD = rf"[{_LETTERS}]+"
_MARKS = r"[.,;:!?%&$*#]*"
_SIMPLE = re.compile(rf" ?{_WORD}{_MARKS}(?:\n{_WORD}{_MARKS})*")
_WORD_AND_MARKS = re.compile(rf"( ?{_WORD})({_MARKS})")
_PIECE = re.compile(rf" ?{_WORD}|{_MARKS[:-1]}+|\n")


class ChunkIds:
    """Ids of the chunks of a byte-level tokenizer, as bytes.

    Pieces of simple chunks go to the model of the tokenizer at once, without its normaliser and
    pattern; all other chunks go through the whole tokenizer.
    """

    def __init__(self, tokenizer):
        self._tokenizer, self._model = tokenizer, tokenizer.model
        # The memo asks for each piece once, so the model's own cache only costs time.
        self._model._resize_cache(0)
        self._characters = _byte_characters()
        self.pieces = Memo(self._piece_ids)

    def _piece_ids(self, pieces: list[str]) -> Iterator[bytes]:
        space, tokenize = self._characters[ord(" ")], self._model.tokenize
        for piece in pieces:
            if piece.isascii() and piece != "\n":
                spelled = space + piece[1:] if piece[:1] == " " else piece
            else:
                spelled = piece.encode().decode("latin-1").translate(self._characters)
            yield id_bytes([token.id for token in tokenize(spelled)])

    def __call__(self, chunks: list) -> list[bytes]:
        texts = [" " + c if isinstance(c, str) else c[0] for c in chunks]
        split = []
        for chunk, text in zip(chunks, texts):
            if isinstance(chunk, str) and chunk.isascii() and chunk.isalpha():
                split.append((text,))
            elif word := _WORD_AND_MARKS.fullmatch(text):
                split.append(word.groups())
            else:
                split.append(_PIECE.findall(text) if _SIMPLE.fullmatch(text) else None)
        known = self.pieces.values(p for p in split if p)
        other = [t for t, p in zip(texts, split) if p is None]
        ids = (id_bytes(e.ids) for e in encodings(self._tokenizer, other))
        return [next(ids) if p is None else b"".join(map(known.__getitem__, p)) for p in split]


def white_chunks(text: bytes) -> list[bytes]:
    """Chunks of a text for tokenizers that drop white space: cut at ASCII white space."""
    return text.split()


# White space of any tokenizer's pattern, and a little more.
_WHITE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
_CUT = re.compile(r"(?<=\S) ")


def space_chunks(text: str) -> list:
    """Chunks of a text for byte-level tokenizers: each but the first starts at a space that
    follows no white space. The pattern of the tokenizer takes a space together with what follows
    it, so nothing goes across such a cut.

    The first chunk is a tuple of its string; the others are given without the space they start at.
    """
    if any(w + " " in text for w in _WHITE):
        chunks = _CUT.split(text)
    else:
        chunks = text.split(" ")
    chunks[0] = (chunks[0],)
    return chunks


# A chunk that is one word and the marks after it, for Arrow.
_SPLIT_WORD = rf"^(?P<word>{_WORD})(?P<marks>{_MARKS})$"
_UNCUT = f"[{_WHITE}] "


def _chunk_lists(texts: pa.Array) -> pa.Array:
    """``space_chunks`` of every text as an array of lists, first chunks as plain strings."""
    lists = pc.split_pattern(texts, " ")
    uncut = np.flatnonzero(pc.match_substring_regex(texts, _UNCUT).to_numpy(zero_copy_only=False))
    if not len(uncut):
        return lists
    chunks = [space_chunks(t) for t in texts.take(pa.array(uncut)).to_pylist()]
    anew = pa.array([[c[0][0], *c[1:]] for c in chunks], lists.type)
    order = np.arange(len(texts))
    order[uncut] = len(texts) + np.arange(len(uncut))
    return pa.concat_arrays([lists, anew]).take(pa.array(order))


def _strings(array: pa.Array) -> list[str]:
    return array.to_numpy(zero_copy_only=False).tolist()


class TextIds:
    """Ids of texts by a byte-level tokenizer.

    Each different chunk of a block is looked at once: Arrow splits it into a word and marks, whose
    ids are in the memo of pieces; first chunks and chunks of another form go to ``ChunkIds``.
    """

    def __init__(self, tokenizer):
        chunk_ids = ChunkIds(tokenizer)
        self._pieces, self._chunks = chunk_ids.pieces, Memo(chunk_ids)
        # First chunks and marks, which no space precedes.
        self._starts = Memo(lambda texts: chunk_ids([(t,) for t in texts]))

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and for each text where its ids end."""
        lists = _chunk_lists(texts)
        bounds, chunks = lists.offsets.to_numpy(), lists.flatten()
        leading = np.zeros(len(chunks), bool)
        leading[bounds[:-1]] = True
        first = _strings(chunks.filter(pa.array(leading)))
        later = chunks.filter(pa.array(~leading)).dictionary_encode()
        split = pc.extract_regex(later.dictionary, _SPLIT_WORD)
        simple = split.is_valid().to_numpy(zero_copy_only=False)
        words, marks = (a.dictionary_encode() for a in split.filter(pa.array(simple)).flatten())
        pieces, runs = [" " + w for w in _strings(words.dictionary)], _strings(marks.dictionary)
        other = _strings(later.dictionary.filter(pa.array(~simple)))
        ids = [b""]
        for memo, keys in (
            (self._pieces, pieces),
            (self._starts, runs),
            (self._chunks, other),
            (self._starts, first),
        ):
            ids += map(memo.values([keys]).__getitem__, keys)
        sizes = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
        ids = np.frombuffer(b"".join(ids), "<u4")
        # Each different chunk is two of the strings: its word and its marks, or all of it and nothing.
        at_marks = 1 + len(pieces)
        at_other = at_marks + len(runs)
        at_first = at_other + len(other)
        parts = np.zeros((len(simple), 2), np.int32)
        parts[simple, 0] = 1 + words.indices.to_numpy()
        parts[simple, 1] = at_marks + marks.indices.to_numpy()
        parts[~simple, 0] = at_other + np.arange(len(other))
        parts = np.append(parts.ravel(), at_first + np.arange(len(first), dtype=np.int32))
        ids, sizes = _joined(ids, sizes, parts)
        n = len(simple)
        sizes = np.append(sizes[: 2 * n : 2] + sizes[1 : 2 * n : 2], sizes[2 * n :])
        # Each chunk of the texts is one of the different chunks, or the first of its text.
        place = np.empty(len(chunks), np.int32)
        place[leading] = n + np.arange(len(first))
        place[~leading] = later.indices.to_numpy()
        ids, sizes = _joined(ids, sizes, place)
        return ids, np.append(0, np.cumsum(sizes))[bounds[1:]]


def _joined(values: np.ndarray, sizes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Strings of values, given one after the other with their sizes, put together anew by their
    places, with the sizes of those."""
    starts = np.cumsum(sizes, dtype=np.int32) - sizes
    lengths = sizes[places]
    ends = np.cumsum(lengths, dtype=np.int32)
    source = np.repeat(starts[places] - (ends - lengths), lengths)
    source += np.arange(len(source), dtype=np.int32)
    return values[source], lengths


@lru_cache(maxsize=1)
def text_ids(name: str) -> TextIds:
    """``TextIds`` of a tokenizer file, one for all tasks that a Python worker runs."""
    return TextIds(load(tokenizer_path(name)))


def document_ids(batches: Iterable[pa.RecordBatch], name: str, end: int) -> Iterator[tuple]:
    """(id, ids of the text and ``end``) of rows of doc_id and text, by the tokenizer file ``name``.
    A null text is empty."""
    encode = text_ids(name)
    for rows, _, _ in blocks(batches, most=BLOCK_BYTES):
        docs = rows.column(0).cast(pa.int64()).to_pylist()
        ids, ends = encode(pc.fill_null(rows.column(1), ""))
        low = 0
        for doc, high in zip(docs, ends.tolist()):
            yield doc, np.append(ids[low:high], np.uint32(end))
            low = high
