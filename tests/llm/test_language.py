import random

from llm_cases import SCHEMA, awkward, awkward_rows, empty
from pyspark.sql import functions as F

from martkit.llm.language import (
    CLASS_ROWS,
    MARGIN,
    UNKNOWN,
    fit_languages,
    held_out,
    identify,
    keep_identified,
    thresholds,
)

SOUNDS = {
    "aa": ["ka", "to", "mi", "ra", "shi", "no"],
    "bb": ["str", "ung", "ver", "lich", "sch", "en"],
    "cc": ["eau", "que", "ment", "tion", "é", "les"],
}


def made(seed, n=600):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SOUNDS))
        words = ["".join(rng.choices(SOUNDS[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(8, 80))]
        rows.append((i, " ".join(words), lang if i % 10 else None, "s", 1))
    return rows


def languages(rows):
    rng = {}
    for doc, text, *_ in rows:
        hits = {k: sum(text.count(x) for x in v if len(x) > 1) for k, v in SOUNDS.items()}
        rng[doc] = max(hits, key=hits.get)
    return rng


def test_held_out_documents_are_named(spark):
    rows = made(1)
    docs = spark.createDataFrame(rows, SCHEMA)
    model = fit_languages(docs, sample=60)
    found = identify(docs, model).collect()
    truth = languages(rows)
    right = [truth[r["doc_id"]] == r["lang_pred"] for r in found]
    assert len(found) == 600 and sum(right) >= 590
    assert all(0 <= r["score"] <= 1 for r in found)
    assert sum(r["rejected"] for r in found) <= 6
    tested = docs.where(held_out(docs["doc_id"])).count()
    assert 100 < tested < 200


def test_held_out_and_unlabelled_rows_teach_nothing(spark):
    rows = [r for r in made(2, 200)]
    docs = spark.createDataFrame(rows, SCHEMA)
    lying = docs.withColumn(
        "lang", F.when(~held_out(docs["doc_id"]), docs["lang"]).otherwise("zz")
    )
    assert "zz" not in fit_languages(lying, sample=50).languages


def test_far_texts_are_rejected(spark):
    docs = spark.createDataFrame(made(3), SCHEMA)
    model = fit_languages(docs, sample=100)
    strange = [(1, "xq zj wv kp " * 30, None, None, 1), (2, "ka to mi ra shi no " * 10, None, None, 1)]
    found = identify(spark.createDataFrame(strange, SCHEMA), model).collect()
    assert {r["doc_id"]: r["rejected"] for r in found} == {1: True, 2: False}
    kept = keep_identified(spark.createDataFrame(strange, SCHEMA), model).collect()
    assert [r["doc_id"] for r in kept] == [2]


def test_far_texts_of_rare_lengths_are_rejected(spark):
    docs = spark.createDataFrame(made(4), SCHEMA)
    model = fit_languages(docs, sample=30)
    strange = [(n, "xq zj wv kp " * n, None, None, 1) for n in (1, 2, 4, 30, 200, 3000)]
    plain = [(-n, "ka to mi ra shi no " * n, None, None, 1) for n in (1, 4, 30, 200, 3000)]
    found = identify(spark.createDataFrame(strange + plain, SCHEMA), model).collect()
    assert {r["doc_id"]: r["rejected"] for r in found} == {
        r[0]: r[0] > 0 for r in strange + plain
    }


def test_thresholds_come_from_all_documents(spark):
    # of 100 texts of a language, most are outside the sample
    docs = spark.createDataFrame(made(5), SCHEMA)
    known = docs.where(~held_out(docs["doc_id"])).where("lang is not null").collect()
    model = fit_languages(docs, sample=10)
    widths = {}
    for row in known:
        width = sum(c.isalpha() for c in row["text"]).bit_length()
        widths.setdefault((row["lang"], width), []).append(row["text"])
    many = {at: texts for at, texts in widths.items() if len(texts) >= CLASS_ROWS}
    assert many
    for at, texts in many.items():
        least = min(score for _, score, _, _ in model.predict(texts))
        assert abs(model.least[at] - MARGIN * least) < 1e-6


def test_sparse_classes_take_the_nearest_threshold():
    lows = {("aa", 5): (0.4, 50), ("aa", 9): (0.8, 50), ("aa", 10): (0.2, 3), ("bb", 9): (0.6, 2)}
    least = thresholds(lows, ["aa", "bb"])
    assert least["aa", 5] == MARGIN * 0.4 and least["aa", 9] == MARGIN * 0.8
    assert least["aa", 1] == least["aa", 7] == MARGIN * 0.4 and least["aa", 17] == MARGIN * 0.8
    assert least["aa", 10] == MARGIN * 0.2
    assert least["bb", 1] == MARGIN * 0.4 and least["bb", 9] == MARGIN * 0.6
    assert thresholds({("aa", 3): (0.5, 2)}, ["aa"]) == {}


def test_awkward_rows(spark):
    frame = awkward(spark)
    model = fit_languages(frame)
    found = identify(frame, model).collect()
    assert len(found) == len(awkward_rows())
    blank = [r for r in found if r["doc_id"] in (3, 4, 7, -4)]
    assert {r["lang_pred"] for r in blank} == {UNKNOWN} and all(r["rejected"] for r in blank)
    assert keep_identified(frame, model).columns == frame.columns


def test_nothing_to_learn_from(spark):
    model = fit_languages(empty(spark))
    assert model.languages == []
    assert identify(empty(spark), model).collect() == []
    assert {r["lang_pred"] for r in identify(awkward(spark), model).collect()} == {UNKNOWN}
