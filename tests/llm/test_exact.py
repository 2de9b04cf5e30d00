import hashlib
from collections import defaultdict

import numpy as np
import pytest
from llm_cases import awkward, empty

from martkit.llm.exact import BASES, PRIMES, chunk_hasher, exact_duplicates, fingerprint_texts


def brute_force(frame):
    groups = defaultdict(list)
    for row in frame.select("doc_id", "text").collect():
        groups[row.text or ""].append(row.doc_id)
    expected = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for place, doc_id in enumerate(sorted(ids, key=lambda i: i != keep)):
            sha = hashlib.sha256(text.encode()).hexdigest()
            expected.append((doc_id, keep, len(ids), place == 0, sha))
    return sorted(expected, key=repr)


def rows_of(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


def value(text, prime, base):
    number = 0
    for byte in text:
        number = (number * base + byte) % prime
    return number


def test_hashes_are_polynomials_modulo_primes():
    for prime in PRIMES:
        assert all(pow(a, prime - 1, prime) == 1 for a in (2, 3, 5, 7, 11))
    draw = np.random.default_rng(1)
    texts = [draw.integers(0, 256, n, np.uint8).tobytes() for n in (0, 1, 1023, 1024, 1025, 65536)]
    found = chunk_hasher()(texts)
    for text, hashes in zip(texts, found.tolist()):
        assert hashes == [value(text, p, b) for p, b in zip(PRIMES, BASES)]


@pytest.mark.parametrize("chunk", [7, 64, 1 << 16])
def test_fingerprints_compose_from_chunks(spark, chunk):
    frame = awkward(spark).where("doc_id is not null").repartition(3)
    texts = {row.doc_id: row.text or "" for row in frame.collect() if row.doc_id != 5}
    found = fingerprint_texts(frame.where("doc_id <> 5"), chunk=chunk).collect()
    assert {row.key for row in found} == texts.keys()
    for row in found:
        text = texts[row.key].encode()
        assert row.n_bytes == len(text)
        assert [row.p0, row.p1, row.p2, row.p3] == [value(text, p, b) for p, b in zip(PRIMES, BASES)]
        assert len(row.codes) == 16 * max(1, -(-len(text) // chunk))


@pytest.mark.parametrize(
    "options",
    [
        {},
        {"chunk": 4096},
        # nothing may be broadcast
        {"max_rows": 0},
        # fingerprints that collide all the time
        {"primes": (5,), "bases": (2,)},
        {"primes": (3,), "bases": (2,), "chunk": 4096},
        {"primes": (3,), "bases": (2,), "chunk": 4096, "max_rows": 0},
    ],
)
def test_equals_brute_force(spark, options):
    frame = awkward(spark).repartition(3)
    assert rows_of(exact_duplicates(frame, **options)) == brute_force(frame)


def test_texts_that_differ_in_one_chunk_only(spark):
    same = "x" * 100
    rows = [(i, same + end + same) for i, end in enumerate(["a", "b", "a", "", "b", "a"])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    for options in ({"chunk": 32}, {"chunk": 32, "primes": (2,), "bases": (1,)}):
        assert rows_of(exact_duplicates(frame, **options)) == brute_force(frame)


def test_zeros_in_front_count(spark):
    frame = spark.createDataFrame(
        [(1, "\0a"), (2, "a"), (3, ""), (4, "\0"), (5, None)], "doc_id bigint, text string"
    )
    assert rows_of(exact_duplicates(frame)) == brute_force(frame)


def test_a_hot_group_and_an_empty_table(spark):
    frame = spark.range(900).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot', concat('t', id)) as text")
    assert rows_of(exact_duplicates(frame)) == brute_force(frame)
    assert exact_duplicates(empty(spark)).collect() == []
