"""Personal data, also in disguise, with spans in the source text.

Base detectors find addresses, IP numbers, cards and phone numbers as they stand. Then a chain of
transducers rewrites disguised text: look-alike characters become plain ones, invisible ones go,
``(at)`` and ``dot`` become signs, spelled digits become digits. Every character of the rewritten
text knows the source characters it came from, so that what the detectors find in it is mapped back
to a span of the source. Texts without any trigger are not rewritten.

Every detector takes time in proportion to the text: candidates are found once and judged once.

Defined results: a null or empty text has no spans. Repeated rows are judged one by one, null ids
are kept, and an empty table gives no rows.
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[int, int]


def emails(text: str) -> list[Span]:
    """Matches of local part, @ and domain, leftmost first, without overlap.

    Only one @ is in a match, so each @ is tried once: the domain must follow it, and the match
    starts where the characters of a local part start, but not inside the match before.
    """
    found, at, done = [], text.find("@"), 0
    while at >= 0:
        follow = at + 1
        domain = _DOMAIN.match(text, at + 1) if at > done and text[at - 1] in _LOCAL else None
        if domain:
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            found.append((start, domain.end()))
            done = follow = domain.end()
        at = text.find("@", follow)
    return found


def ips(text: str) -> list[Span]:
    """Four numbers joined by dots, each at most 255. A longer chain is read four at a time."""
    found = []
    for chain in _DOTTED.finditer(text):
        if chain[0].count(".") < 3:
            continue
        parts, at = chain[0].split("."), chain.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in four):
                found.append((at, end))
            at = end + 1
    return found


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def cards(text: str) -> list[Span]:
    found = []
    for m in _DIGITS.finditer(text):
        if 13 <= m.end() - m.start() <= 37:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                found.append(m.span())
    return found


def phones(text: str) -> list[Span]:
    return [
        m.span() for m in _PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m[0])) <= 15
    ]


def detect(text: str) -> dict[str, list[Span]]:
    found = dict.fromkeys(KINDS, [])
    if "@" in text:
        found["email"] = emails(text)
    if _DIGIT.search(text):
        found["ip"], found["card"] = ips(text), cards(text)
        if "+" in text:
            found["phone"] = phones(text)
    return found


# Letters of other scripts that look like Latin ones, and the words of disguises.
LOOK_ALIKES = dict(
    zip(
        "АВЕЅІЈКМНОРСТХУаеѕіјорсхуԁԛԝһӏΑΒΕΖΗΙΚΜΝΟΡΤΥΧανορυχ",
        "ABESIJKMHOPCTXYaesijopcxydqwhlABEZHIKMNOPTYXavopux",
    )
)
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
AT_WORDS = ("at", "arroba")
DOT_WORDS = ("dot", "punto", "punkt")
DIGIT_WORDS = {
    "zero": "0",
    "oh": "0",
    "one": "1",
    "two": "2",
    "three": "3",
    "four": "4",
    "five": "5",
    "six": "6",
    "seven": "7",
    "eight": "8",
    "nine": "9",
}
# Shorter runs of digit words are prose.
LEAST_DIGIT_WORDS = 4

_STRANGE = re.compile(
    "[" + "".join(LOOK_ALIKES) + INVISIBLE + "\u00a0\u00b2\u00b3\u00b9\u2000-\u200a\u2010-\u2015\u202f"
    "\u205f\u2070-\u2089\u2212\u2460-\u2468\u3000\uff01-\uff5e\U0001d400-\U0001d7ff]"
)
_ENTITY = re.compile(r"&(?:#0*64|#[xX]0*40|commat|#0*46|#[xX]0*2[eE]|period|#0*43|plus);")
_at, _dot = "|".join(AT_WORDS), "|".join(DOT_WORDS)
_BRACKET_AT = re.compile(rf"\s*[\[({{<]\s*(?:{_at}|@)\s*[\])}}>]\s*", re.I)
_BRACKET_DOT = re.compile(rf"\s*[\[({{<]\s*(?:{_dot}|\.)\s*[\])}}>]\s*", re.I)
_JOIN = rf"(?:\.|\s+(?:{_dot})\s+)"
_SPELLED_ADDRESS = re.compile(
    rf"\b[A-Za-z0-9_%+-]+(?:{_JOIN}[A-Za-z0-9_%+-]+)*\s+(?:{_at})\s+"
    rf"[A-Za-z0-9-]+(?:{_JOIN}[A-Za-z0-9-]+)*\s+(?:{_dot})\s+[A-Za-z]{{2,}}\b",
    re.I,
)
_HALF_SPELLED = re.compile(
    rf"(?<=[A-Za-z0-9])\s*@\s*[A-Za-z0-9-]+(?:{_JOIN}[A-Za-z0-9-]+)*(?:\s+(?:{_dot})\s+|\.)[A-Za-z]{{2,}}\b",
    re.I,
)
_SIGN_WORD = re.compile(rf"\s+(?:{_at}|{_dot})\s+|\s+@\s*|@\s+", re.I)
_NUMBER_DOT = re.compile(rf"(?<=[0-9])\s+(?:{_dot}|point)\s+(?=[0-9])", re.I)
_word = "|".join(DIGIT_WORDS)
_GAP = r"(?:[\s,-]+|\s*[.]\s*)"
_SPELLED = re.compile(
    rf"(?:\bplus{_GAP})?\b(?:{_word})\b(?:{_GAP}(?:(?:dot|point){_GAP})?(?:{_word})\b){{{LEAST_DIGIT_WORDS - 1},}}",
    re.I,
)
_SPELLED_WORD = re.compile(rf"plus|dot|point|{_word}", re.I)
_MAYBE_SPELLED = re.compile(rf"\b(?:{_word})\b{_GAP}(?:(?:dot|point){_GAP})?(?:{_word})\b", re.I)


class Rewritten:
    """A text and, for each of its characters, the span of the source it stands for."""

    def __init__(self, text: str):
        self.text = text
        self.starts = list(range(len(text)))
        self.ends = list(range(1, len(text) + 1))

    def rewrite(self, pattern: re.Pattern, parts) -> None:
        """Replace each match by ``parts(match)``: (characters, first, end) over the match."""
        out, starts, ends, done = [], [], [], 0
        for m in pattern.finditer(self.text):
            low = m.start()
            out.append(self.text[done:low])
            starts += self.starts[done:low]
            ends += self.ends[done:low]
            for characters, first, end in parts(m):
                out.append(characters)
                starts += [self.starts[first]] * len(characters)
                ends += [self.ends[end - 1]] * len(characters)
            done = m.end()
        if out:
            out.append(self.text[done:])
            self.starts = starts + self.starts[done:]
            self.ends = ends + self.ends[done:]
            self.text = "".join(out)

    def source(self, span: Span) -> Span:
        return self.starts[span[0]], self.ends[span[1] - 1]


def _plain(character: str) -> str:
    if character in INVISIBLE:
        return ""
    if character in LOOK_ALIKES:
        return LOOK_ALIKES[character]
    if character in "\u2010\u2011\u2012\u2013\u2014\u2015\u2212":
        return "-"
    return unicodedata.normalize("NFKC", character)


def _sign(m: re.Match) -> str:
    return "@" if m[0].strip().lower() in (*AT_WORDS, "@") else "."


def _entity(m: re.Match) -> str:
    name = m[0].lower()
    if "64" in name or "x" in name and "40" in name or "commat" in name:
        return "@"
    return "+" if "43" in name or "plus" in name else "."


def _spelled_signs(m: re.Match):
    """An address with spelled signs: the words become signs, the rest stays as it is."""
    done = m.start()
    for sign in _SIGN_WORD.finditer(m.string, m.start(), m.end()):
        for k in range(done, sign.start()):
            yield m.string[k], k, k + 1
        yield _sign(sign), sign.start(), sign.end()
        done = sign.end()
    for k in range(done, m.end()):
        yield m.string[k], k, k + 1


def _spelled_digits(m: re.Match):
    signs = {"plus": "+", "dot": ".", "point": "."}
    for w in _SPELLED_WORD.finditer(m.string, m.start(), m.end()):
        yield {**DIGIT_WORDS, **signs}[w[0].lower()], w.start(), w.end()


def disguised(text: str) -> Rewritten | None:
    """The text without its disguises; None if it has no trigger of any."""
    strange = not text.isascii() and _STRANGE.search(text)
    entity = "&" in text and _ENTITY.search(text)
    low = text.lower()
    dots = any(w in low for w in DOT_WORDS) or "point" in low
    brackets = any(b in text for b in "[({<")
    spelled = _MAYBE_SPELLED.search(low)
    if not (strange or entity or dots or brackets or spelled or " @" in text or "@ " in text):
        return None
    out = Rewritten(text)
    if strange:
        out.rewrite(_STRANGE, lambda m: [(_plain(m[0]), m.start(), m.end())])
    if entity:
        out.rewrite(_ENTITY, lambda m: [(_entity(m), m.start(), m.end())])
    if brackets or strange:
        out.rewrite(_BRACKET_AT, lambda m: [("@", m.start(), m.end())])
        out.rewrite(_BRACKET_DOT, lambda m: [(".", m.start(), m.end())])
    out.rewrite(_SPELLED, _spelled_digits)
    if dots or strange:
        out.rewrite(_SPELLED_ADDRESS, _spelled_signs)
        out.rewrite(_NUMBER_DOT, lambda m: [(".", m.start(), m.end())])
    if "@" in out.text:
        out.rewrite(_HALF_SPELLED, _spelled_signs)
    return out if out.text != text else None


def all_spans(text: str) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """Base spans, and all spans: the base ones and those found behind disguises.

    A found span that meets a base span of its kind is only added if it goes beyond it.
    """
    base = detect(text)
    rewritten = disguised(text)
    if rewritten is None:
        return base, base
    everything = {}
    for kind, spans in detect(rewritten.text).items():
        new = {rewritten.source(s) for s in spans} - set(base[kind])
        met = sorted(base[kind])
        new = {
            (s, e)
            for s, e in new
            if all(s <= b and e >= f for b, f in met if b < e and f > s)
        }
        everything[kind] = sorted({*base[kind], *new})
    return base, everything


def _joined(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for kind in KINDS for s, e in sorted(spans[kind]))


def _found(batches):
    for batch in batches:
        texts, rows = pc.fill_null(batch.column(1), ""), []
        for text in texts:
            base, spans = all_spans(text.as_py())
            rows.append((*(len(base[k]) for k in KINDS), _joined(base), _joined(spans)))
        columns = list(zip(*rows))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).cast(pa.int64()),
                *(pa.array(c, pa.int64()) for c in columns[:4]),
                *(pa.array(c, pa.string()) for c in columns[4:]),
            ],
            names=["doc_id", *(f"n_{k}" for k in KINDS), "base_spans", "spans"],
        )


def find_personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_spans, spans); counts are of base spans.

    Spans are written as kind:start:end in code points, end exclusive.
    """
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return docs.select("doc_id", "text").mapInArrow(
        _found, f"doc_id bigint, {counts}, base_spans string, spans string"
    )
