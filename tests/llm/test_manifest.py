import hashlib
import itertools
from collections import defaultdict

import pytest
from llm_cases import awkward, empty
from pyspark.sql import functions as F

from martkit.llm.manifest import (
    FIELDS,
    append_nodes,
    build_manifest,
    fold,
    height,
    log_entries,
    postorder,
    prove,
)


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, **changed):
    shown = []
    for field in FIELDS:
        value = changed.get(field, row[field])
        text = None if value is None else str(value)
        shown.append("-" if text is None else f"{len(text.encode())}:{text}")
    return sha(*shown)


def levels_of(leaves):
    """All levels of a tree, from the leaves to its root."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return levels


def path_of(levels, place):
    """Per level (side, sibling) or None."""
    steps = []
    for level in levels[:-1]:
        other = place ^ 1
        steps.append((other & 1, level[other]) if other < len(level) else None)
        place >>= 1
    return steps


def first_null(value):
    return (value is not None, value)


def brute_force(rows, shown=lambda row: {}):
    trees = defaultdict(list)
    for row in rows:
        trees[row.lang].append(row)
    names = sorted(trees, key=lambda n: (n is not None, (n or "").encode()))
    for name in names:
        trees[name].sort(key=lambda row: (first_null(row.doc_id), leaf_of(row)))
    each = {name: levels_of([leaf_of(row) for row in trees[name]]) for name in names}
    top = levels_of([each[name][-1][0] for name in names])
    out = []
    for at, name in enumerate(names):
        for place, row in enumerate(trees[name]):
            steps = path_of(each[name], place) + path_of(top, at)
            digest = leaf_of(row, **shown(row))
            for step in steps:
                pair = [digest] if step is None else [digest, step[1]] if step[0] else [step[1], digest]
                digest = sha(*pair)
            proof = sha(*[step[1] for step in steps if step])
            root = top[-1][0]
            out.append(
                (row.doc_id, leaf_of(row), each[name][-1][0], root, proof, digest, digest == root)
            )
    return sorted(out, key=repr)


def rows_of(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


@pytest.mark.parametrize("leaves", [*range(1, 18), 31, 32, 33])
def test_the_log_is_in_postorder(leaves):
    digests = [hashlib.sha256(bytes([i])).digest() for i in range(leaves)]
    levels = height(leaves)
    log = append_nodes(digests, levels)
    whole = levels_of([d.hex() for d in digests])

    def walk(level, index):
        for child in (2 * index, 2 * index + 1):
            if level and child < len(whole[level - 1]):
                yield from walk(level - 1, child)
        yield level, index

    order = list(walk(levels, 0))
    assert len(log) == 32 * len(order)
    for position, (level, index) in enumerate(order):
        assert postorder(level, index, leaves, levels) == position
        assert log[32 * position : 32 * position + 32].hex() == whole[level][index]


@pytest.mark.parametrize("bits", [1, 2, 10])
def test_awkward_rows_equal_brute_force(spark, bits):
    frame = awkward(spark).repartition(3)
    longer = {"n_chars": F.when(F.col("doc_id") % 2 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}

    def shown(row):
        even = row.doc_id is not None and row.doc_id % 2 == 0 and row.n_chars is not None
        return {"n_chars": row.n_chars + 1} if even else {}

    found = rows_of(prove(build_manifest(frame, presented=longer, bits=bits)))
    assert found == brute_force(frame.collect(), shown)
    assert {row[-1] for row in found} == {True, False}


@pytest.mark.parametrize("bits", [2, 3])
def test_trees_of_many_builders(spark, bits):
    frame = spark.range(150).selectExpr(
        "id as doc_id", "'s' as source", "if(id < 101, 'x', concat('l', id % 7)) as lang",
        "id as n_chars", "concat('text ', id) as text",
    )
    manifest = build_manifest(frame.repartition(5), bits=bits)
    assert rows_of(prove(manifest)) == brute_force(frame.collect())

    # proofs can be checked by anyone, without the log
    for row in prove(manifest, with_siblings=True).collect():
        left = iter(row.siblings)
        path = [(side, bytes.fromhex(next(left)) if side >= 0 else b"") for side in row.sides]
        assert fold(bytes.fromhex(row.leaf), path).hex() == row.root
        assert sha(*row.siblings) == row.proof_sha256

    # builders' logs together are the log of each tree
    entries = log_entries(manifest).collect()
    trees = defaultdict(list)
    for row in frame.orderBy("doc_id").collect():
        trees["=" + row.lang].append(leaf_of(row))
    for tree, leaves in trees.items():
        own = sorted((e.position, e.level, e.place, e.digest.hex()) for e in entries if e.tree == tree)
        whole = levels_of(leaves)
        assert [e[0] for e in own] == list(range(sum(map(len, whole))))
        for position, level, index, digest in own:
            assert digest == whole[level][index]
            assert postorder(level, index, len(leaves), height(len(leaves))) == position


def test_repeated_rows_are_spread(spark):
    frame = spark.range(300).selectExpr(
        "if(id % 3 = 0, 7, id) as doc_id", "'s' as source", "'x' as lang",
        "1l as n_chars", "if(id % 3 = 0, 'hot', 'cold') as text",
    )
    found = rows_of(prove(build_manifest(frame.repartition(4), bits=3)))
    assert [row[:4] for row in found] == [row[:4] for row in brute_force(frame.collect())]
    expected = brute_force(frame.collect())
    assert sorted(found, key=repr) == expected and all(row[-1] for row in found)


def test_one_row_and_none(spark):
    one = awkward(spark).limit(1)
    (row,) = prove(build_manifest(one)).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.verified
    assert row.proof_sha256 == sha()
    assert prove(build_manifest(empty(spark))).collect() == []
    assert list(itertools.islice(log_entries(build_manifest(empty(spark))).collect(), 1)) == []
