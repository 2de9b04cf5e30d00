import math
import zlib

import pytest
import xxhash
from llm_cases import SCHEMA, awkward, awkward_rows, empty
from pyspark.sql import functions as F

from martkit.llm.sharding import ROUNDS, feistel, place_documents, shard_rows, write_shards


@pytest.mark.parametrize("n", [1, 2, 3, 5, 7, 10, 16, 17, 99, 1000, 4097])
def test_feistel_is_a_permutation(spark, n):
    rows = spark.range(n).select(feistel(F.col("id"), n, 7).alias("p")).collect()
    assert sorted(r["p"] for r in rows) == list(range(n))


def test_feistel_shuffles(spark):
    rows = spark.range(5000).select("id", feistel(F.col("id"), 5000, 7).alias("p")).collect()
    kept = sum(abs(r["id"] - r["p"]) < 50 for r in rows)
    assert kept < 250
    other = spark.range(5000).select(feistel(F.col("id"), 5000, 8).alias("p")).collect()
    assert [r["p"] for r in rows] != [r["p"] for r in other]


def test_awkward_rows(spark):
    found = shard_rows(awkward(spark), shards=3).collect()
    rows = awkward_rows()
    assert len(found) == len(rows)
    expected = sorted(
        (r[0] or 0, len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows
    )
    assert sorted((r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in found) == expected
    for shard in range(3):
        slots = sorted(r["slot"] for r in found if r["shard"] == shard)
        assert slots == list(range(len(slots))) and len(slots) in (4, 5)


def test_result_does_not_depend_on_layout(spark):
    frame = awkward(spark, clashing=False)
    a = shard_rows(frame.coalesce(1)).collect()
    b = shard_rows(frame.repartition(7)).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_a_third_of_equal_rows(spark):
    rows = [(1, "same", "en", "a", 4)] * 1000 + [(i, f"t{i}", "en", "a", 4) for i in range(2000)]
    found = shard_rows(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len({(r["shard"], r["slot"]) for r in found}) == 3000


def test_documents_are_carried_whole(spark, tmp_path):
    frame = awkward(spark)
    found = place_documents(frame, 2).select("document.*").collect()
    assert sorted(map(str, found)) == sorted(map(str, frame.collect()))
    write_shards(frame, str(tmp_path / "out"), 2)
    assert spark.read.parquet(str(tmp_path / "out")).count() == frame.count()


def test_empty_table(spark):
    assert shard_rows(empty(spark)).collect() == []
    assert place_documents(empty(spark)).collect() == []


def test_no_shards(spark):
    with pytest.raises(ValueError):
        shard_rows(empty(spark), 0)


def spark_hash(*values):
    """Spark's 64-bit hash of (number, byte width) pairs: each seeds the next."""
    seed = 42
    for number, width in values:
        seed = xxhash.xxh64_intdigest(number.to_bytes(width, "little", signed=True), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def plain_feistel(number, rows, seed):
    a = math.isqrt(rows - 1) + 1
    b = -(-rows // a)
    value = number
    while True:
        left, right = value % a, value // a
        for turn in range(ROUNDS):
            left = (left + spark_hash((right, 8), (turn, 4), (seed, 4)) % a) % a
            right = (right + spark_hash((left, 8), (turn, 4), (~seed, 4)) % b) % b
        value = left + right * a
        if value < rows:
            return value


@pytest.mark.parametrize("rows", [1, 2, 7, 97, 1000])
def test_equals_a_plain_walk(spark, rows):
    found = spark.range(rows).select("id", feistel(F.col("id"), rows, 42).alias("position")).collect()
    assert {r["id"]: r["position"] for r in found} == {i: plain_feistel(i, rows, 42) for i in range(rows)}


def test_documents_lie_where_the_walk_puts_them(spark):
    docs = spark.range(300).selectExpr("id as doc_id", "concat('text ', id % 250) as text")
    placed = shard_rows(docs, shards=8).collect()
    assert sorted(r["row_number"] for r in placed) == list(range(300))
    for r in placed:
        position = plain_feistel(r["row_number"], 300, 42)
        assert (r["shard"], r["slot"]) == (position % 8, position // 8)
