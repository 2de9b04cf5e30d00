"""Personal data in texts, plain or disguised, with exact places.

Plain identifiers are found by fixed patterns. Then a chain of transducers rewrites
the text: look-alike letters and invisible characters, digits spelled as words, and
"at" and "dot" disguises. Each keeps, for every character it puts out, the stretch of
the source that it stands for. The patterns run over the rewritten text as well, and
what they find is mapped back to the source; a find inside a plain one of its kind is
the plain one again and is dropped. One that reaches further is kept beside it.

Null and empty texts have no finds. Texts are read whole, in time proportional to
their length. Repeated rows are answered one by one; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import bound_batches, quoted

KINDS = ("email", "ip", "card", "phone")

# The patterns of the plain identifiers. A match of the second starts
# where a run of digits does, or a longer one would start there.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Stretches that alone can hold a match of the last three.
NUMERIC = re.compile(r"[0-9+][0-9\x20().+-]{6,}")

# Characters that look like ASCII ones. Full-width forms follow a rule.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m",
    "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q",
    "ԝ": "w", "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K",
    "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "У": "Y", "Х": "X", "α": "a", "ε": "e",
    "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "Α": "A",
    "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ı": "i", "ɑ": "a", "ɡ": "g", "․": ".", "‧": ".",
    "。": ".", "﹒": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "﹫": "@",
    " ": " ", " ": " ", " ": " ", " ": " ",
}
LOOK_ALIKES.update({chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)})
# Digits of other scripts are given by their first one.
for _zero in (0x0660, 0x06F0, 0x0966, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6):
    LOOK_ALIKES.update({chr(_zero + d): str(d) for d in range(10)})
INVISIBLE = "­​‌‍⁠﻿"
LATIN_ODD = [c for c in [*LOOK_ALIKES, *INVISIBLE] if ord(c) < 256]
ODD = re.compile("[" + re.escape("".join(LOOK_ALIKES) + INVISIBLE) + "]")

# Names of the digits.
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "null": "0", "cero": "0", "zéro": "0",
    "one": "1", "eins": "1", "uno": "1", "un": "1",
    "two": "2", "zwei": "2", "dos": "2", "deux": "2",
    "three": "3", "drei": "3", "tres": "3", "trois": "3",
    "four": "4", "vier": "4", "cuatro": "4", "quatre": "4",
    "five": "5", "fünf": "5", "cinco": "5", "cinq": "5",
    "six": "6", "sechs": "6", "seis": "6",
    "seven": "7", "sieben": "7", "siete": "7", "sept": "7",
    "eight": "8", "acht": "8", "ocho": "8", "huit": "8",
    "nine": "9", "neun": "9", "nueve": "9", "neuf": "9",
}
_DIGIT = r"(?:" + "|".join(sorted(DIGIT_WORDS, key=len, reverse=True)) + r")"
# Words for the sign and the point of an address.
SIGN_WORDS = ("at", "arroba")
POINT_WORDS = ("dot", "point", "punkt", "punto")
_SIGN, _DOT = "(?:" + "|".join(SIGN_WORDS) + ")", "(?:" + "|".join(POINT_WORDS) + ")"
_POINT = rf"\s+{_DOT}\s+"
# Four named digits in a row, at least; single ones are ordinary words.
SPELLED = re.compile(
    rf"(?i)\b(?=[a-zéü])(?:plus\s+)?{_DIGIT}(?:(?:{_POINT}|[\s,-]{{1,3}}){_DIGIT}){{3,}}\b"
)
TOKEN = re.compile(rf"(?i)plus|{_DOT}|{_DIGIT}")
DOTTED = re.compile(rf"(?i)(?<![0-9])[0-9]+(?:{_POINT}[0-9]+){{3}}")

BRACKETED = re.compile(rf"(?i)[\(\[\{{<]\s{{0,3}}({_SIGN}|{_DOT})\s{{0,3}}[\)\]\}}>]")
# Words joined by points are taken as a whole, whether the rest of an address follows
# (then there is a group) or not, so that long chains are not read again from each word.
_PART = r"[a-z0-9._%+-]++"
_REST = rf"\s+{_SIGN}\s+[a-z0-9.-]+(?:{_POINT}[a-z0-9-]+)+"
_CHAIN = rf"(?i)(?<![a-z0-9._%+-]){_PART}(?:\s++{_DOT}\s++{_PART})"
SPACED = re.compile(rf"{_CHAIN}++({_REST})?|(?<![a-z0-9._%+-]){_PART}({_REST})")
AFTER_SIGN = re.compile(rf"(?i)(@)[a-z0-9.-]+(?:{_POINT}[a-z0-9-]+)+")
BEFORE_SIGN = re.compile(rf"{_CHAIN}++(@)?")
WORD = re.compile(rf"(?i)\s+({_SIGN}|{_DOT})\s+")


def passes_luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """An address starts where the run of its characters before the sign does."""
    end, sign = 0, text.find("@")
    while sign >= 0:
        start = sign
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, sign) if start < sign else None
        if found:
            end = found.end()
            yield start, end
        sign = text.find("@", max(sign + 1, end))


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start."""
    spans = [("email", *span) for span in emails(text)]
    ips, cards, phones = [], [], []
    for stretch in NUMERIC.finditer(text):
        at = stretch.span()
        for m in IP.finditer(text, *at):
            parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
            if all(len(p) <= 3 and int(p) <= 255 for p in parts):
                ips.append(("ip", *m.span()))
        for m in CARD.finditer(text, *at):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and passes_luhn(digits):
                cards.append(("card", *m.span()))
        for m in PHONE.finditer(text, *at):
            if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
                phones.append(("phone", *m.span()))
    return spans + ips + cards + phones


class Rewritten:
    """A text with, for each of its characters, the source stretch it stands for."""

    def __init__(self, text: str):
        self.text = text
        self.starts = np.arange(len(text))
        self.ends = self.starts + 1

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Put strings in place of stretches, given in order and without overlap."""
        if not edits:
            return
        texts, starts, ends, at = [], [], [], 0
        for start, end, new in edits:
            texts += [self.text[at:start], new]
            starts += [self.starts[at:start], np.repeat(self.starts[start : start + 1], len(new))]
            ends += [self.ends[at:start], np.repeat(self.ends[end - 1 : end], len(new))]
            at = end
        self.text = "".join([*texts, self.text[at:]])
        self.starts = np.concatenate([*starts, self.starts[at:]])
        self.ends = np.concatenate([*ends, self.ends[at:]])

    def source(self, start: int, end: int) -> tuple[int, int]:
        return int(self.starts[start]), int(self.ends[end - 1])


def look_alikes(text: str) -> list[tuple[int, int, str]]:
    if text.isascii():
        return []
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        pass
    else:
        if not any(c in text for c in LATIN_ODD):
            return []
    return [(m.start(), m.end(), LOOK_ALIKES.get(m[0], "")) for m in ODD.finditer(text)]


def spelled_digits(text: str) -> list[tuple[int, int, str]]:
    """Named digits become digits; what parts them goes, but for points."""
    words = text.lower().replace(",", " ").replace("-", " ").split()
    if DIGIT_WORDS.keys().isdisjoint(words):
        return []
    edits = []
    for run in SPELLED.finditer(text):
        at = run.start()
        for token in TOKEN.finditer(text, run.start(), run.end()):
            if token.start() > at:
                edits.append((at, token.start(), ""))
            word = token[0].lower()
            new = "+" if word == "plus" else DIGIT_WORDS.get(word, ".")
            edits.append((token.start(), token.end(), new))
            at = token.end()
    return edits


def bracketed_signs(text: str) -> list[tuple[int, int, str]]:
    edits, last = [], 0
    for m in BRACKETED.finditer(text):
        start, end = m.span()
        while start > last and start > m.start() - 3 and text[start - 1].isspace():
            start -= 1
        while end < len(text) and end < m.end() + 3 and text[end].isspace():
            end += 1
        edits.append((start, end, "@" if m[1].lower() in SIGN_WORDS else "."))
        last = end
    return edits


def spaced_signs(text: str) -> list[tuple[int, int, str]]:
    """Bare words are signs only inside the shape of an address."""
    lower = text.lower()
    if not any(word in lower for word in POINT_WORDS):
        return []
    edits: dict[int, tuple[int, int, str]] = {}
    for shape in (SPACED, AFTER_SIGN, BEFORE_SIGN, DOTTED):
        for found in shape.finditer(text):
            if shape.groups and found.lastindex is None:
                continue
            for m in WORD.finditer(text, found.start(), found.end()):
                new = "." if m[1].lower() in POINT_WORDS else "@"
                edits.setdefault(m.start(), (m.start(), m.end(), new))
    return [edits[at] for at in sorted(edits)]


TRANSDUCERS = (look_alikes, spelled_digits, bracketed_signs, spaced_signs)


def disguised_spans(
    text: str, plain: list[tuple[str, int, int]]
) -> list[tuple[str, int, int]]:
    """Finds of the rewritten text that lie in no plain one of their kind."""
    rewritten = Rewritten(text)
    for transducer in TRANSDUCERS:
        rewritten.replace(transducer(rewritten.text))
    if rewritten.text == text:
        return []
    # plain finds of one kind are in order and do not overlap
    taken = {kind: [(a, b) for k, a, b in plain if k == kind] for kind in KINDS}
    found = []
    for kind, start, end in plain_spans(rewritten.text):
        start, end = rewritten.source(start, end)
        before = bisect_right(taken[kind], start, key=itemgetter(0))
        if not before or taken[kind][before - 1][1] < end:
            found.append((kind, start, end))
    return found


def find_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(plain finds, all finds), by kind in the order of KINDS, then start."""
    plain = plain_spans(text)
    added = disguised_spans(text, plain)
    every = sorted(plain + added, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return plain, every


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Each find replaced by its kind; of overlapping ones the first and longest counts."""
    parts, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
            at = end
        elif end > at:
            at = end
    return "".join([*parts, text[at:]])


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


SCHEMA = "doc_id bigint, " + "".join(f"n_{kind} bigint, " for kind in KINDS)
SCHEMA += "base_sha256 string, spans string, n_added bigint"


def detect_pii(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and hash of the plain finds, and all finds, of every document."""
    bound_batches(docs.sparkSession)

    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans", "n_added"]
        types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()]
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for doc, body in zip(batch.column(0), batch.column(1)):
                plain, every = find_spans(body.as_py() or "")
                kinds = [kind for kind, _, _ in plain]
                digest = hashlib.sha256(joined(plain).encode()).hexdigest()
                row = [doc.as_py(), *map(kinds.count, KINDS), digest, joined(every)]
                for column, value in zip(out, [*row, len(every) - len(plain)]):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, types)], names=names
            )

    rows = docs.select(quoted(key).cast("bigint").alias("doc_id"), quoted(text).alias("text"))
    return rows.mapInArrow(detect, SCHEMA)


def redact_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every find in the text replaced by its kind in brackets."""
    bound_batches(docs.sparkSession)

    @F.arrow_udf("string")
    def hide(texts: pa.Array) -> pa.Array:
        bodies = (body.as_py() for body in texts)
        hidden = [None if b is None else redact(b, find_spans(b)[1]) for b in bodies]
        return pa.array(hidden, pa.string())

    return docs.withColumn(text, hide(quoted(text)))
