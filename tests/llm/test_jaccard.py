import random
from pathlib import Path

import numpy as np
import pytest
from llm_cases import SCHEMA, awkward, awkward_rows, empty

import martkit.llm.jaccard as jaccard
from martkit.llm.graph import components
from martkit.llm.jaccard import jaccard_components
from martkit.session import materialize


def shingle_set(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    width = min(width, len(words))
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def plain(rows, percent, width):
    """(doc_id, set size, component) by comparing all pairs."""
    sets = [shingle_set(text, width) for _, text in rows]
    above = list(range(len(rows)))

    def root(x):
        while above[x] != x:
            x = above[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                above[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    out = [(doc, len(sets[i]), least.get(root(i), doc)) for i, (doc, _) in enumerate(rows)]
    return sorted(out, key=str)


def found(frame, percent=85, width=4):
    rows = jaccard_components(frame, percent, width).collect()
    return sorted([tuple(r) for r in rows], key=str)


def made(seed, docs=260):
    """Texts with copies, chains of ever more edits, common passages, and short ones."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(docs):
        kind = rng.random()
        if kind < 0.35 and rows:
            text = (rows[rng.randrange(max(0, len(rows) - 40), len(rows))][1] or "").split()
            for _ in range(rng.randint(0, 4)):
                if text:
                    text[rng.randrange(len(text))] = rng.choice(words)
            if rng.random() < 0.3:
                text = text[: rng.randint(len(text) * 4 // 5, len(text))]
        elif kind < 0.5:
            text = rng.choices(words, k=rng.randint(0, 6))
        else:
            text = rng.choices(words, k=rng.randint(10, 120))
            if rng.random() < 0.6:
                text[len(text) // 2 : len(text) // 2] = passage
        if rng.random() < 0.1:
            text = passage + rng.choices(words, k=rng.randint(0, 12))
        rows.append((i * 3 - 50, " ".join(text)))
    return rows


@pytest.mark.parametrize("seed,percent,width", [(1, 85, 4), (3, 60, 2)])
@pytest.mark.parametrize("small", [True, False])
def test_equals_all_pairs(spark, monkeypatch, seed, percent, width, small):
    if small:  # frequent shingles and large regions from a few documents on
        monkeypatch.setattr(jaccard, "FREQUENT", 3)
        monkeypatch.setattr(jaccard, "DIRECT", 2)
        monkeypatch.setattr(jaccard, "CELL_ROWS", 7)
    rows = made(seed)
    frame = spark.createDataFrame([(d, t, "en", "a", 1) for d, t in rows], SCHEMA)
    assert found(frame.repartition(5), percent, width) == plain(rows, percent, width)


def test_large_group_of_near_copies(spark):
    rng = random.Random(5)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(400):
        text = list(base)
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(120)] = f"x{rng.randrange(40)}"
        rows.append((i, " ".join(text)))
    frame = spark.createDataFrame([(d, t, "en", "a", 1) for d, t in rows], SCHEMA)
    assert found(frame) == plain(rows, 85, 4)


def long_texts(copies=4, others=50):
    """Long texts that have a passage in common; the first ones are near copies."""
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(90)]
    base = [f"b{i}" for i in range(3000)]
    rows = []
    for i in range(copies + others):
        text = list(base) if i < copies else [f"w{rng.randrange(10**6)}" for _ in range(3000 + i)]
        text[100 * i : 100 * i] = passage
        text[rng.randrange(len(text))] = f"x{i}"
        rows.append((i, " ".join(text)))
    return rows


def test_whole_sets_of_long_texts_are_gathered_for_likely_pairs_only(spark, monkeypatch):
    gathered = []

    def stored(df, name):
        out = materialize(df, name)
        if name == "jaccard-sets":
            gathered.append({r["node"] for r in out.select("node").collect()})
        return out

    monkeypatch.setattr(jaccard, "materialize", stored)
    monkeypatch.setattr(jaccard, "DIRECT", 8)
    rows = long_texts()
    frame = spark.createDataFrame([(d, t, "en", "a", 1) for d, t in rows], SCHEMA)
    assert found(frame) == plain(rows, 85, 4)
    assert set().union(*gathered) and len(set().union(*gathered)) <= 4


@pytest.mark.parametrize("percent", [80, 85])
def test_wide_sketches_never_differ_in_more_than_the_sets(percent):
    rng = np.random.default_rng(percent)
    numbers = np.sort(rng.integers(0, 1 << 63, 40_000, dtype=np.uint64))
    assert jaccard.wide_sketch_of(numbers[:300], percent) is None
    assert jaccard.wide_sketch_of(numbers, 100) is None
    for n, m in [(4000, 4000), (4096, 3600), (9000, 2000), (20_000, 20_000), (39_000, 39_000)]:
        one, other = (np.sort(rng.choice(numbers, k, replace=False)) for k in (n, m))
        wides = [jaccard.wide_sketch_of(x, percent) for x in (one, other)]
        least = jaccard.least_wide_different(*[np.frombuffer(w, dtype=np.uint8) for w in wides])
        assert least <= len(np.setxor1d(one, other))
        # unlike sets are told from linked ones
        if n - m < 500 and n <= 20_000:
            assert least * (100 + percent) > (n + m) * (100 - percent)


def test_no_shuffles_and_no_sets_are_left_behind(spark):
    def left():
        disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        files = [str(p) for d in disk.localDirsString() for p in Path(d).rglob("shuffle_*")]
        return {Path(f).name.split("_")[1] for f in files}

    frame = spark.createDataFrame([(d, t, "en", "a", 1) for d, t in made(2)], SCHEMA)
    before = left()
    jaccard_components(frame)
    # the last look-up is measured outside
    assert len(left() - before) <= 2


def test_awkward_rows(spark):
    rows = [(r[0], r[1]) for r in awkward_rows()]
    assert found(awkward(spark)) == plain(rows, 85, 4)


def test_empty_table(spark):
    assert found(empty(spark)) == []


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)]
    edges += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    above = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            above[a] = above[b] = min(above[a], above[b])
    rows = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    joined = {x for a, b in edges if a != b for x in (a, b)}
    assert {r["node"]: r["component"] for r in rows} == {x: above[x] for x in joined}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
