import re
from collections import Counter

import numpy as np
import pytest
from llm_cases import awkward, empty

import __spark_entry__  # noqa: F401  ships the package by value, so patched constants reach the tasks
from martkit.llm import lexical
from martkit.llm.lexical import (
    BLOCK,
    STEPS,
    build_index,
    entry_keys,
    length_norm,
    search,
    slice_numbers,
    term_score,
    term_weight,
    terms_of,
)

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_force(docs, queries, k):
    rows = [(row.doc_id, Counter(words(row.text))) for row in docs.collect()]
    rows = [(doc, counts) for doc, counts in rows if counts]
    documents, terms = len(rows), sum(counts.total() for _, counts in rows)
    out = []
    for item, text in {(row.item_id, row.text) for row in queries.collect()}:
        scored = []
        for doc, counts in rows:
            norm = length_norm(counts.total(), documents, terms)
            value = 0
            for term in set(words(text)) & counts.keys():
                holding = sum(term in other for _, other in rows)
                value += term_weight(documents, holding) * term_score(counts[term], norm)
            if value > 0:
                scored.append((-value, doc is not None, doc))
        for rank, (value, _, doc) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, doc, -value))
    return sorted(out, key=repr)


def rows_of(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


def corpus(spark, n=300):
    """Texts of unlike lengths over common and rare words, some of them often repeated."""
    draw = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for doc in range(n):
        size = int(draw.integers(1, 400))
        chosen = draw.zipf(1.3, size) % len(vocabulary)
        rows.append((doc, " ".join(vocabulary[c] for c in chosen)))
    rows += [(1000 + i, "w7 w7 w7 w300 Übung") for i in range(n // 3)]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def asked(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string")


def test_terms():
    text = "Grüße, ÀB_c 12-3 \U0001f600x y\tZ\x7fq\x00r"
    assert [t.decode() for t in terms_of(text.encode())] == words(text)


@pytest.mark.parametrize("k", [1, 7, 50])
def test_equals_brute_force(spark, k):
    docs = corpus(spark).repartition(5)
    queries = asked(spark, "w1 w300 w2 w2", "W7 übung Übung", "w399 w398 w397", "nowhere", "", "...")
    found = rows_of(search(build_index(docs), docs, queries, k))
    assert found == brute_force(docs, queries, k)


def test_lots_and_small_blocks_give_the_same(spark, monkeypatch):
    docs = corpus(spark).repartition(3)
    queries = asked(spark, "w1 w300", "w7 w399", "w5 w50 w100 w200", "w7")
    monkeypatch.setattr(lexical, "LOT_ITEMS", 2)
    monkeypatch.setattr(lexical, "LOT_TERMS", 3)
    found = rows_of(search(build_index(docs), docs, queries, 5))
    assert found == brute_force(docs, queries, 5)


def test_crowded_signatures_give_the_same(spark, monkeypatch):
    docs = corpus(spark, 120).repartition(3)
    queries = asked(spark, "w1 w300", "w7 w399 w250")
    monkeypatch.setattr(lexical, "MOST_WIDTH", 128)
    index = build_index(docs)
    widths = {row.width for row in index.entries.where(f"kind = {BLOCK}").collect()}
    assert widths == {128}
    assert rows_of(search(index, docs, queries, 5)) == brute_force(docs, queries, 5)


def test_awkward_rows(spark):
    docs = awkward(spark).repartition(3)
    queries = spark.createDataFrame(
        [(1, "The FOX, the Mill"), (1, "köln"), (None, "word1 other3 12"), (2, None), (3, ""), (1, "köln")],
        "item_id bigint, text string",
    ).selectExpr("*", "1 as key", "2 as number", "3 as terms")
    found = rows_of(search(build_index(docs), docs, queries, 4))
    assert found == brute_force(docs, queries, 4)
    assert {row[2] for row in found} >= {None, 1, 2, 5, 8}


def test_empty_tables(spark):
    docs, none = corpus(spark, 9), asked(spark, "x").limit(0)
    assert search(build_index(docs), docs, none).collect() == []
    assert search(build_index(empty(spark)), empty(spark), asked(spark, "x")).collect() == []


def test_bounds_are_never_below_scores(spark):
    docs = corpus(spark)
    index = build_index(docs.repartition(2))
    held = {row.term.decode(): row.number for row in _terms(index)}
    asked_terms = {t.encode(): term_weight(index.documents, held[t]) for t in ("w1", "w7", "w300", "w2")}
    lot = lexical._Lot([0], [asked_terms])
    bounder = lexical._Bounder(lot, index.documents, index.terms)
    exact = {}
    for row in docs.selectExpr("xxhash64(text) as hash", "text").collect():
        counts = Counter(terms_of(row.text.encode()))
        norm = length_norm(counts.total(), index.documents, index.terms)
        exact[row.hash] = sum(
            w * term_score(counts[t], norm) for t, w in asked_terms.items() if t in counts
        )
    seen, total, close = 0, 0, 0
    for block in index.entries.where(f"kind = {BLOCK}").collect():
        lengths, texts = (np.frombuffer(block[c], np.int64) for c in ("lengths", "texts"))
        (bounds,) = bounder.bounds(block.width, lengths, block.slices)
        for bound, text in zip(bounds.tolist(), texts.tolist()):
            assert bound >= exact[text]
            seen, total, close = seen + 1, total + 1, close + (bound <= 1.3 * exact[text])
    assert seen == docs.count() == index.documents
    assert close > 0.9 * total


def _terms(index):
    counts = index.entries.where("kind = 1").groupBy("term").sum("number")
    return counts.toDF("term", "number").collect()


def test_document_frequencies_and_totals(spark):
    docs = corpus(spark)
    index = build_index(docs.repartition(4))
    texts = [words(row.text) for row in docs.collect()]
    assert index.documents == len(texts) and index.terms == sum(map(len, texts))
    expected = Counter(term for text in texts for term in set(text))
    assert {row.term.decode(): row.number for row in _terms(index)} == expected


def test_steps_and_slices():
    assert STEPS[:8] == [1, 2, 3, 4, 6, 8, 12, 16] and STEPS == sorted(set(STEPS))
    keys = entry_keys(np.arange(2000, dtype=np.uint64), 0)
    assert len(np.unique(keys)) == 2000
    assert not np.intersect1d(keys, entry_keys(np.arange(2000, dtype=np.uint64), 1)).size
    slots = slice_numbers(keys, 1024)
    assert slots.shape == (lexical.HASHES, 2000) and 0 <= slots.min() and slots.max() < 1024
    # all slices are used alike
    assert np.bincount(slots.ravel(), minlength=1024).max() < 40
