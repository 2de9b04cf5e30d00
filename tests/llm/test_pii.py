import hashlib
import random
import re

import pytest
from llm_cases import awkward, awkward_rows, empty

from martkit.llm.pii import (
    KINDS,
    detect_pii,
    find_spans,
    joined,
    passes_luhn,
    plain_spans,
    redact,
    redact_pii,
)

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def slow(text):
    """The base finds by the patterns as they are written."""
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [
        ("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))
    ]
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m[0])
        if 13 <= len(digits) <= 19 and passes_luhn(digits):
            out.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_base_finds_equal_the_patterns():
    rng = random.Random(1)
    for signs in ("0012345a.@+-_ () xé", "0123456789 .-", "ab.@-", "+12 ().-"):
        for _ in range(4000):
            text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 50)))
            assert plain_spans(text) == slow(text), text


@pytest.mark.parametrize(
    "text,kind,source",
    [
        ("mail john (at) example [dot] com now", "email", "john (at) example [dot] com"),
        ("to john dot smith at example dot co dot uk", "email", "john dot smith at example dot co dot uk"),
        ("ｊｏｈｎ@ｅxample.com", "email", "ｊｏｈｎ@ｅxample.com"),
        ("an аlice@exаmple.com x", "email", "аlice@exаmple.com"),
        ("bob@exam​ple.com", "email", "bob@exam​ple.com"),
        ("no 4​111111111111111 x", "card", "4​111111111111111"),
        ("one nine two dot one six eight dot one dot five", "ip", None),
        ("call plus one five five five one two three four five six seven ok", "phone", "plus one five five five one two three four five six seven"),
        ("ip 192 dot 168 dot 1 dot 5", "ip", "192 dot 168 dot 1 dot 5"),
        ("\U0001f600 x (at) y (dot) org", "email", "x (at) y (dot) org"),
    ],
)
def test_disguises_are_found_in_place(text, kind, source):
    plain, every = find_spans(text)
    assert plain == slow(text)
    assert [(k, text[a:b]) for k, a, b in every] == [(kind, source or text)]


@pytest.mark.parametrize(
    "text,source,base",
    [
        ("to john dot doe@example.com now", "john dot doe@example.com", "doe@example.com"),
        ("an аlice@example.com x", "аlice@example.com", "lice@example.com"),
        ("x john@mail.example dot com", "john@mail.example dot com", "john@mail.example"),
        ("ip 1.2.3.4５ x", "1.2.3.4５", "1.2.3.4"),
    ],
)
def test_disguises_around_a_plain_find(text, source, base):
    plain, every = find_spans(text)
    assert [text[a:b] for _, a, b in plain] == [base]
    assert plain == slow(text) and set(plain) <= set(every)
    assert source in [text[a:b] for _, a, b in every] and len(every) == 2
    assert redact(text, every) == text.replace(source, f"[{plain[0][0].upper()}]")


@pytest.mark.parametrize(
    "source",
    [
        "john at example dot\ncom",
        "john at example\u00a0dot\tcom",
        "juan arroba ejemplo punto com",
        "hans at beispiel punkt de",
        "jean point petit@exemple.fr",
        "ana@ejemplo punto es",
        "a dot b.c at x dot org",
    ],
)
def test_point_words_and_wrapped_lines(source):
    text = f"x, {source}, y"
    every = find_spans(text)[1]
    assert source in [text[a:b] for _, a, b in every]


def test_chains_of_points_take_linear_time():
    for text in ("a dot " * 50_000, "a" * 300_000 + " dot b", "1" * 300_000 + " punto 2", "a" + " " * 300_000 + "dot"):
        assert find_spans(text) == ([], [])


def test_point_words_of_prose_stay():
    for text in ("un punto de vista", "at this point in time", "der Punkt ist klar", "à ce point il part"):
        assert find_spans(text) == ([], [])


def test_clean_texts_stay_clean():
    for text in (
        "We met at the mill at noon. One of two, or three; dot the i.",
        "one two three",
        "Look at example. He is at home [at] last (dot)",
        "тест и проверка",
        "El punto [punto] es uno dos tres",
    ):
        assert find_spans(text) == ([], [])


def test_base_finds_stay():
    rng = random.Random(2)
    parts = ["a@b.co", " at ", " dot ", "(at)", "[dot]", "1.2.3.4", "+1 (555) 555-1234", "one ", "x", "４", " "]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        plain, every = find_spans(text)
        assert plain == slow(text) and set(plain) <= set(every)
        assert every == sorted(every, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def test_redaction():
    text = "x a@b.co y 4111 1111 1111 1111 z"
    assert redact(text, find_spans(text)[1]) == "x [EMAIL] y [CARD] z"
    assert redact("abcdef", [("ip", 1, 4), ("card", 2, 5)]) == "a[IP]f"


def test_awkward_rows(spark):
    frame = awkward(spark)
    found = detect_pii(frame).collect()
    assert len(found) == len(awkward_rows())
    assert {r["base_sha256"] for r in found} == {hashlib.sha256(b"").hexdigest()}
    hidden = redact_pii(frame)
    assert hidden.columns == frame.columns
    assert sorted(map(str, hidden.collect())) == sorted(map(str, frame.collect()))
    assert detect_pii(empty(spark)).collect() == [] and redact_pii(empty(spark)).collect() == []


def test_digests(spark):
    text = "\U0001f600 a@b.co, c@d.org 1.2.3.4 x (at) y (dot) org"
    row = detect_pii(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    base = joined(slow(text))
    assert row["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
    assert (row["n_email"], row["n_ip"], row["n_card"], row["n_phone"], row["n_added"]) == (2, 1, 0, 0, 1)
    assert "email:26:44" in row["spans"]


def test_long_texts_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000, "1." * 150_000, "+1" * 100_000, "a@" * 100_000, "(at) " * 50_000):
        find_spans(text)
