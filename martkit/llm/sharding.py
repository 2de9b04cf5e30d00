"""Sharding by a Feistel permutation of global row numbers.

Every row gets a number, a keyed permutation of 0..n-1 moves it to a position, and
the position alone says shard (position mod shards) and slot (position div shards).
Given seed, shard count and number of rows, anyone can compute where row r went.

Row numbers follow (bucket, key, row hash), so they depend on the rows and not on
how these lie in files. Identical rows are counted before the shuffle and share one
interval of numbers, so no group of copies meets in one task.

Null texts count as no bytes, null keys sort first, and an empty table gives an
empty result. Columns of any name are carried by ``place_documents``; the working
columns of this module are taken from a projection, so names cannot clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martkit.llm.common import quoted
from martkit.session import materialize

# Row numbers are given bucket by bucket. The list of bucket sizes is all that one
# task ever sees; it has at most so many rows whatever the table holds.
BUCKETS = 16_384

ROUNDS = 6
KEYS = ["doc_id", "size", "text_crc32", "row_hash"]


def feistel(number: Column, rows: int, seed: int, rounds: int = ROUNDS) -> Column:
    """The position of row ``number`` under a permutation of 0..rows-1.

    A balanced network on Z_a x Z_b with a*b >= rows and a*b - rows < a permutes
    0..a*b-1. A value outside 0..rows-1 is permuted again until it falls inside; it
    meets no outside value twice, so a*b - rows steps always suffice. About one row
    in sqrt(rows) takes such a step at all.
    """
    rows = max(rows, 1)
    a = math.isqrt(rows - 1) + 1
    b = -(-rows // a)

    def once(value: Column) -> Column:
        def step(halves: Column, turn: Column) -> Column:
            left, right = halves["left"], halves["right"]
            moved = F.pmod(left + F.pmod(F.xxhash64(right, turn, F.lit(seed)), F.lit(a)), F.lit(a))
            back = F.pmod(right + F.pmod(F.xxhash64(moved, turn, F.lit(~seed)), F.lit(b)), F.lit(b))
            return F.struct(moved.alias("left"), back.alias("right"))

        low = F.pmod(value, F.lit(a)).cast("bigint")
        high = ((value - low) / a).cast("bigint")
        start = F.struct(low.alias("left"), high.alias("right"))
        turns = F.array(*[F.lit(i) for i in range(rounds)])
        return F.aggregate(turns, start, step, lambda h: h["left"] + h["right"] * a)

    first = once(number)
    if a * b == rows:
        return first
    # made to depend on the row, or the plan would hold an array of that many literals
    outside = F.pmod(number, F.lit(1)) + (a * b - rows)
    walk = F.aggregate(
        F.sequence(F.lit(1).cast("bigint"), outside),
        first,
        lambda value, _: F.when(value < rows, value).otherwise(once(value)),
    )
    return F.when(first < rows, first).otherwise(walk)


def number_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, int]:
    """(KEYS, copies, first): the interval of row numbers of each different row; and n."""
    body = quoted(text)
    rows = docs.select(
        quoted(key).alias("doc_id"),
        (F.coalesce(F.octet_length(body), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(body, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(*[quoted(c) for c in docs.columns]).alias("row_hash"),
    )
    bucket = F.pmod(F.xxhash64(*KEYS), F.lit(BUCKETS)).cast("int")
    counted = rows.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("copies"))
    counted = materialize(counted.withColumn("bucket", bucket), "shard-rows")

    sizes = counted.groupBy("bucket").agg(F.sum("copies").alias("in_bucket"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("in_bucket").over(before), F.lit(0))
    bases = sizes.select("bucket", base.alias("base"))
    total = counted.agg(F.sum("copies")).first()[0] or 0

    earlier = (
        Window.partitionBy("bucket").orderBy(*KEYS).rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = F.coalesce(F.sum("copies").over(earlier), F.lit(0))
    placed = counted.withColumn("inside", inside).join(F.broadcast(bases), "bucket")
    return placed.select(*KEYS, "copies", (F.col("base") + F.col("inside")).alias("first")), total


def shard_rows(
    docs: DataFrame, shards: int = 8, seed: int = 42, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: KEYS, row_number, shard and slot.

    Shard sizes differ by one row at most and slots run from 0 without a gap.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    intervals, total = number_rows(docs, key, text)
    numbers = F.sequence(F.col("first"), F.col("first") + F.col("copies") - 1)
    rows = intervals.select(*KEYS, F.explode(numbers).alias("row_number"))
    rows = rows.withColumn("position", feistel(F.col("row_number"), total, seed))
    shard = F.pmod("position", F.lit(shards)).cast("int")
    return rows.select(
        *KEYS,
        "row_number",
        shard.alias("shard"),
        ((F.col("position") - shard) / shards).cast("bigint").alias("slot"),
    )


def place_documents(
    docs: DataFrame, shards: int = 8, seed: int = 42, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(shard, slot, document): every row of ``docs``, whole, with its place.

    ``document`` is a struct of all columns. Copies of a row are moved once and
    repeated where they are placed.
    """
    body = quoted(text)
    rows = docs.select(
        quoted(key).alias("doc_id"),
        (F.coalesce(F.octet_length(body), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(body, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(*[quoted(c) for c in docs.columns]).alias("row_hash"),
        F.struct(*[quoted(c) for c in docs.columns]).alias("document"),
    )
    places = shard_rows(docs, shards, seed, key, text)
    kept = rows.dropDuplicates(KEYS)
    on = [kept[c].eqNullSafe(places[c]) for c in KEYS]
    return kept.join(places, on).select("shard", "slot", "document")


def write_shards(docs: DataFrame, path: str, shards: int = 8, seed: int = 42) -> None:
    """One folder per shard, its rows in slot order within each file."""
    placed = place_documents(docs, shards, seed)
    ordered = placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(path)
