import hashlib
import random

import pytest
from llm_cases import SCHEMA, awkward, awkward_rows, empty
import martkit.llm.fingerprints as fingerprints
import martkit.llm.hamming as hamming
from martkit.llm.fingerprints import (
    BITS,
    WordHashes,
    add_near,
    edited_fingerprints,
    fingerprint,
    fingerprint_documents,
)
from martkit.llm.hamming import blocks_used, count_near, near_fingerprints


def plain(rows):
    """(doc_id, n_chars, hash of the edited text) by sorting all rows."""
    out = []
    for i, (doc, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    return sorted(out, key=str)


def test_neighbours_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 10)
    rng = random.Random(1)
    rows = [(i * 7, "wörd " * rng.randint(0, 9) + f"n{i} x") for i in range(300)]
    rng.shuffle(rows)
    frame = spark.createDataFrame([(d, t, "en", "a", 1) for d, t in rows], SCHEMA)
    found = edited_fingerprints(frame).collect()
    rows.sort(reverse=True)
    assert sorted([(r[0], r[1], r[2]) for r in found], key=str) == plain(rows)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in found)
    marks = {r["doc_id"]: r["fingerprint"] for r in fingerprint_documents(frame).collect()}
    assert marks == {r["doc_id"]: r["fingerprint"] for r in found}


def test_awkward_rows(spark):
    found = edited_fingerprints(awkward(spark)).collect()
    assert len(found) == len(awkward_rows())
    texts = {r[0]: r[1] or "" for r in awkward_rows() if r[0] is not None}
    for r in found:
        if r["doc_id"] is not None:
            assert r["n_chars"] == len(texts[r["doc_id"]])
    same = {r["fingerprint"] for r in found if r["doc_id"] in (1, 2)}
    assert len(same) == 1
    blank = {r["fingerprint"] for r in found if r["doc_id"] in (3, 4, 7)}
    assert blank == {"0" * (BITS // 4)}


def test_one_row_and_empty_table(spark):
    one = spark.createDataFrame([(1, "abcdef", "en", "a", 1)], SCHEMA)
    row = edited_fingerprints(one).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest()
    assert edited_fingerprints(empty(spark)).collect() == []


def test_like_texts_have_like_fingerprints():
    hashes = WordHashes()
    rng = random.Random(2)
    for _ in range(20):
        words = [f"w{rng.randrange(5000)}" for _ in range(400)]
        edited = list(words)
        edited[7] = "other"
        a, b = (fingerprint(" ".join(w), hashes) for w in (words, edited))
        c = fingerprint(" ".join(rng.choices(words, k=400)[::-1]) + " z", hashes)
        assert fingerprints.likeness(a, b) > 0.9 > fingerprints.likeness(a, c)


def planted(rng, n=40, copies=160, flips=5):
    """Random fingerprints and such that differ from them in a few bits."""
    marks = [rng.getrandbits(BITS) for _ in range(n)]
    for _ in range(copies):
        mark = rng.choice(marks)
        for _ in range(rng.randint(0, flips)):
            mark ^= 1 << rng.randrange(BITS)
        marks.append(mark)
    return marks


def as_hex(mark):
    return f"{mark:0{BITS // 4}x}"


@pytest.mark.parametrize("radius, used", [(3, None), (3, 2), (12, 2), (20, 1)])
def test_tables_find_all_within_the_radius(spark, monkeypatch, radius, used):
    if used:
        monkeypatch.setattr(hamming, "blocks_used", lambda *_: used)
    marks = sorted(set(planted(random.Random(radius), flips=2 * radius)))
    expected = {
        (a, b, (a ^ b).bit_count())
        for a in marks
        for b in marks
        if 0 < (a ^ b).bit_count() <= radius
    }
    texts = [(as_hex(m),) for m in marks] + [(None,), (as_hex(marks[0]),)]
    frame = spark.createDataFrame(texts, "fingerprint string")
    found = near_fingerprints(frame, frame, radius).collect()
    assert len(expected) > 50 and len(found) == len(expected)
    assert {(int(r[0], 16), int(r[1], 16), r[2]) for r in found} == expected


def test_full_buckets_are_split(spark, monkeypatch):
    monkeypatch.setattr(hamming, "BLOCK", 8)
    monkeypatch.setattr(hamming, "STRIP", 3)
    # one group of near copies, some of them often
    rng = random.Random(5)
    marks = planted(rng, n=1, copies=150, flips=4) + planted(rng, n=20, copies=20)
    rows = [(i, as_hex(m)) for i, m in enumerate(marks + marks[:60] + [marks[0]] * 30)]
    frame = spark.createDataFrame([*rows, (None, as_hex(marks[0])), (999, None)], "doc_id long, fingerprint string")
    numbers = [int(m, 16) for _, m in rows] + [marks[0]]
    found = {r["doc_id"]: r for r in add_near(frame, radius=6, every=3).collect()}
    assert len(found) == len(rows) + 2 and found[None]["n_near"] is None
    for doc, mark in rows:
        apart = sorted((int(mark, 16) ^ m).bit_count() for m in numbers)[1:]
        near = [d for d in apart if d <= 6]
        expected = (len(near), near[0] if near else None) if doc % 3 == 0 else (None, None)
        assert (found[doc]["n_near"], found[doc]["nearest_bits"]) == expected


def test_search_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id bigint, fingerprint string")
    some = spark.createDataFrame([(50, "0" * 32), (7, "0" * 31 + "1")], none.schema)
    assert add_near(none).collect() == []
    assert count_near(none, some).collect() == [] and count_near(some, none).collect() == []
    found = {r["doc_id"]: (r["n_near"], r["nearest_bits"]) for r in add_near(some).collect()}
    assert found == {50: (1, 1), 7: (None, None)}


def test_tables_grow_with_the_fingerprints():
    assert [blocks_used(n // 50, n, 3) for n in (10**3, 10**6, 10**9)] == sorted(
        blocks_used(n // 50, n, 3) for n in (10**3, 10**6, 10**9)
    )
    assert blocks_used(2 * 10**7, 10**9, 20) > blocks_used(20, 1000, 20)
    with pytest.raises(ValueError):
        blocks_used(1, 1, BITS)


def test_near_copies_are_within_the_radius():
    """Texts that share 0.8 of their five-word shingles, edited at places by chance."""
    hashes, rng = WordHashes(), random.Random(6)
    apart = []
    for _ in range(60):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(300, 900))]
        edited = list(words)
        for at in rng.sample(range(len(words)), len(words) // 60):
            edited[at] = "other"
        a, b = (fingerprint(" ".join(w), hashes) for w in (words, edited))
        runs = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (words, edited)]
        assert 0.8 <= len(runs[0] & runs[1]) / len(runs[0] | runs[1]) < 0.9
        apart.append(round((1 - fingerprints.likeness(a, b)) * BITS))
    assert sum(d <= fingerprints.RADIUS for d in apart) >= 57
