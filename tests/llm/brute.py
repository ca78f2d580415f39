"""Plain versions of what the operators return, for small inputs: one text or pair at a time."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text)


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def url_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return lower(host), re.match(r"[^?#]*", rest[len(host) :])[0]


def url_rule(host, path, rules):
    fit = [
        (f"{h}{p}", v)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fit, key=lambda x: len(x[0]), default=(None, None))


def line_dedup(docs, length=40, least=5):
    keys, holders = {}, defaultdict(set)
    for doc, text in docs:
        lines = (text or "").split("\n")
        keys[doc] = [(line, lower(line.strip(WHITE))) for line in lines]
        for _, key in keys[doc]:
            if len(key) >= length:
                holders[key].add(doc)
    out = {}
    for doc, lines in keys.items():
        kept = [
            line
            for line, key in lines
            if not (len(holders[key]) >= least and doc != max(holders[key]))
        ]
        out[doc] = (len(lines), len(lines) - len(kept), sha("\n".join(kept)))
    return out


def suffix_dedup(docs, width=50):
    first = {}
    for doc, text in sorted(docs, key=lambda d: d[0]):
        data = (text or "").encode()
        for i in range(len(data) - width + 1):
            first.setdefault(data[i : i + width], doc)
    out = {}
    for doc, text in docs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - width + 1):
            if first[data[i : i + width]] < doc:
                gone[i : i + width] = b"\1" * width
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out[doc] = (len(data), sum(gone), spans, sha(kept))
    return out


def window_dedup(docs, width=13):
    first = {}
    words = {doc: WORD.findall(text or "") for doc, text in docs}
    for doc in sorted(words):
        for i in range(len(words[doc]) - width + 1):
            first.setdefault(tuple(words[doc][i : i + width]), doc)
    out = {}
    for doc, w in words.items():
        gone = set()
        for i in range(len(w) - width + 1):
            if first[tuple(w[i : i + width])] < doc:
                gone.update(range(i, i + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[doc] = (len(w), len(gone), sha(kept))
    return out


def fingerprint(text):
    words = WORD.findall(lower(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(
        1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)
    )


def components(docs, bits=3):
    prints = {doc: fingerprint(text) for doc, text in docs}
    parent = {p: p for p in prints.values()}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    different = sorted(parent)
    for i, a in enumerate(different):
        for b in different[:i]:
            if (a ^ b).bit_count() <= bits:
                parent[find(a)] = find(b)
    smallest = {}
    for doc in sorted(prints):
        smallest.setdefault(find(prints[doc]), doc)
    return {doc: (f"{p:016x}", smallest[find(p)]) for doc, p in prints.items()}


def quality_base(text):
    words, lines = WORD.findall(text or ""), (text or "").split("\n")
    full = [x for x in lines if WORD.search(x)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = defaultdict(int)
    for g in grams:
        count[g] += 1
    again = {j for i, g in enumerate(grams) if count[g] > 1 for j in range(i, i + 5)}
    n = len(words)
    return (
        n,
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(full) - len(set(full)),
        len(again),
        n < 10 or 100 * len(again) > 20 * n,
    )


def contamination(text, items):
    patterns = defaultdict(set)
    for item, t in items:
        w = ALNUM.findall(lower(t or ""))
        m = min(10, len(w))
        for i in range(len(w) - m + 1 if w else 0):
            patterns[tuple(w[i : i + m])].add(str(item))
    w, hit, found = ALNUM.findall(lower(text or "")), set(), set()
    for m in {len(p) for p in patterns}:
        for i in range(len(w) - m + 1):
            p = tuple(w[i : i + m])
            if p in patterns:
                hit.update(range(i, i + m))
                found |= patterns[p]
    return len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def personal_data(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def pieces_are_whole(rows, docs, tokenizer, capacity=1024):
    """Raises unless every id lies in one piece and sequences are filled without gaps."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == {d for d, _ in docs}
    for doc, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            data = b"".join(i.to_bytes(4, "little") for i in ids[at : at + r["length"]])
            assert r["ids_crc32"] == zlib.crc32(data)
            at += r["length"]
        assert at == len(ids)
    padding = 0
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding


def best_fit_is_whole(rows, docs, tokenizer, capacity):
    """Raises unless documents are cut as they may be, and sequences are filled without gaps."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == {d for d, _ in docs}
    for doc, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        at, parts = 0, sorted(by_doc[doc], key=lambda r: r["piece"])
        assert len(parts) == -(-len(ids) // capacity)
        for nth, r in enumerate(parts):
            assert (r["piece"], r["start"]) == (nth, at)
            assert r["length"] == capacity or nth == 0
            data = b"".join(i.to_bytes(4, "little") for i in ids[at : at + r["length"]])
            assert r["ids_crc32"] == zlib.crc32(data)
            at += r["length"]
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


SEARCH_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked_search(docs, items, k=10):
    """For each item the list of (doc, score), best first, all documents scored."""
    terms = [(d, Counter(SEARCH_TERM.findall(lower(t or "")))) for d, t in docs]
    terms = [(d, c) for d, c in terms if c]
    n_docs, n_terms = len(terms), sum(c.total() for _, c in terms)
    df = Counter(t for _, c in terms for t in c)
    out = []
    for item, text in items:
        asked, found = SEARCH_TERM.findall(lower(text or "")), []
        for doc, c in terms:
            m = 100 - 75 + 75 * c.total() * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                for t in asked
                if c[t]
            )
            if score > 0:
                found.append((doc, score))
        found.sort(key=lambda x: (-x[1], x[0] is None, x[0]))
        out += [(item, rank, *x) for rank, x in enumerate(found[:k], 1)]
    return out


def spelling_words(docs):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def spelling(words):
    """word -> (form, root, n, n_near, form_n), every pair compared."""
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    forms = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = {}
    for w in words:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out[w] = (forms[w], root, words[w], len(near[w]), words.get(forms[w]))
    return out


def near_groups(docs):
    """The smallest id of each group linked by a similarity of 0.8 of five-word shingles."""
    sets = []
    for doc, text in docs:
        w = WORD.findall(lower(text or ""))
        sets.append((doc, {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()))
    parent = {doc: doc for doc, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            if 5 * len(x & y) >= 4 * len(x | y):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {find(doc) for doc, _ in sets}
