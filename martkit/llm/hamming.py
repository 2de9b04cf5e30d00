"""Search of fingerprints within a Hamming radius by permuted block tables.

The bits are cut into blocks, ``radius`` more than a table uses. Two fingerprints within
the radius agree in at least as many blocks as a table uses, so one table for each choice
of blocks finds every pair. How many blocks a table uses (few tables of large buckets, or
many of small ones) follows from the numbers of fingerprints; results do not depend on it.

Equal fingerprints are filed once, with their number. Buckets of many fingerprints are
split into blocks of rows, and each two of these meet in a task of their own, so a group
of near copies makes many small tasks. A pair is taken up by the first table that it
shares, so it is found once. Nothing is capped.

Null fingerprints are near nothing; empty inputs give no rows.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import bound_batches
from martkit.llm.embeddings import _blocks
from martkit.operators.joins import lookup_join
from martkit.session import materialize

BITS = 128
# Fingerprints of one side of a bucket that one task takes up.
BLOCK = 8192
# Fingerprints of the queries' side that are compared at once.
STRIP = 64
# Seconds that filing a fingerprint in a table and comparing two take, about; they decide
# how many blocks a table uses.
FILING, COMPARING = 2e-6, 3e-9
# A table's key has at most so many bits.
KEY_BITS = 62
PLACE = ["place", "piece"]


def lanes(mark: Column) -> tuple[Column, Column]:
    """Both halves of a hex fingerprint, as signed numbers."""
    half = BITS // 8
    return tuple(
        F.conv(F.substring(mark, at, half), 16, -10).cast("bigint") for at in (1, half + 1)
    )


def digits(high: str, low: str) -> Column:
    """The hex fingerprint of two halves."""
    return F.concat(*[F.lpad(F.lower(F.hex(F.col(x))), BITS // 8, "0") for x in (high, low)])


def blocks_used(queries: int, marks: int, radius: int) -> int:
    """How many blocks a table shall use."""

    def seconds(used: int) -> float:
        tables = math.comb(radius + used, used)
        buckets = 2.0 ** (BITS * used / (radius + used))
        return tables * ((queries + marks) * FILING + queries * marks / buckets * COMPARING)

    possible = [
        k for k in range(1, 7) if radius + k <= BITS and k * -(-BITS // (radius + k)) <= KEY_BITS
    ]
    if not possible:
        raise ValueError(f"no tables for a radius of {radius}")
    return min(possible, key=seconds)


class Tables:
    """How fingerprints are cut into blocks, and these chosen for tables."""

    def __init__(self, radius: int, used: int) -> None:
        count = radius + used
        self.edges = [i * BITS // count for i in range(count + 1)]
        self.choices = list(itertools.combinations(range(count), used))

    def blocks(self, marks: np.ndarray) -> np.ndarray:
        """(fingerprints, blocks): the number in each block of rows of two 64-bit halves."""
        raw = marks.astype(">u8").view(np.uint8).reshape(len(marks), BITS // 8)
        bits = np.unpackbits(raw, axis=1).astype(np.int64)
        cut = zip(self.edges[:-1], self.edges[1:])
        return np.stack([bits[:, a:b] @ (1 << np.arange(b - a)) for a, b in cut], axis=1)

    def pieces(self, marks: np.ndarray) -> np.ndarray:
        """(fingerprints, tables): the key in each table."""
        found = self.blocks(marks)
        keys = np.zeros((len(marks), len(self.choices)), dtype=np.int64)
        for place, choice in enumerate(self.choices):
            for i in choice:
                keys[:, place] = (keys[:, place] << (self.edges[i + 1] - self.edges[i])) | found[:, i]
        return keys


def _halves(high: pa.Array, low: pa.Array) -> np.ndarray:
    return np.stack([high.to_numpy(), low.to_numpy()], axis=1).view(np.uint64)


def _dealt(rows: DataFrame, tables: Tables) -> DataFrame:
    """(place, piece, low, high, asked, hi, lo, weight): rows in each bucket that they meet in.

    ``rows`` are (asked, hi, lo, weight); ``low`` and ``high`` number the blocks of rows
    of the queries and of the others.
    """

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            # a row is filed under many keys, so few rows are taken at a time
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                keys = tables.pieces(_halves(batch.column(1), batch.column(2)))
                of = pa.array(np.repeat(np.arange(len(keys)), keys.shape[1]))
                places = np.tile(np.arange(keys.shape[1], dtype=np.int32), len(keys))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(places), pa.array(keys.ravel()), *(c.take(of) for c in batch.columns)],
                    names=[*PLACE, "asked", "hi", "lo", "weight"],
                )

    filed = rows.mapInArrow(
        file, "place int, piece bigint, asked boolean, hi bigint, lo bigint, weight bigint"
    )
    sizes = filed.groupBy(*PLACE).agg(
        F.count_if("asked").alias("asking"), F.count_if(~F.col("asked")).alias("others")
    )
    full = sizes.where((F.greatest("asking", "others") > BLOCK) & (F.col("asking") > 0))
    full = full.select(*PLACE, *[F.ceil(F.col(c) / BLOCK).cast("int").alias(c) for c in ("asking", "others")])
    filed = lookup_join(filed, materialize(full, "full-tables"), PLACE, "left")
    asking, others = (F.greatest(F.coalesce(c, F.lit(1)), F.lit(1)) for c in ("asking", "others"))
    mine = F.when(F.col("asked"), asking).otherwise(others)
    theirs = F.when(F.col("asked"), others).otherwise(asking)
    filed = filed.withColumns(
        {
            "own": F.pmod(F.xxhash64("hi", "lo"), mine).cast("int"),
            "other": F.explode(F.sequence(F.lit(0), theirs - 1)),
        }
    )
    filed = filed.select(
        *PLACE,
        F.when(F.col("asked"), F.col("own")).otherwise(F.col("other")).alias("low"),
        F.when(F.col("asked"), F.col("other")).otherwise(F.col("own")).alias("high"),
        "asked",
        "hi",
        "lo",
        "weight",
    )
    meet = [*PLACE, "low", "high"]
    return filed.repartition(*meet).sortWithinPartitions(*meet)


def _found(
    batches: Iterator[pa.RecordBatch], tables: Tables, radius: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(queries, others, weights of these, distances, which pairs are near), a strip each."""
    for columns in _blocks(batches, 4):
        choice = tables.choices[columns[0][0].as_py()]
        asked = columns[4].to_numpy(zero_copy_only=False)
        if asked.all() or not asked.any():
            continue
        marks, weight = _halves(columns[5], columns[6]), columns[7].to_numpy()
        right, weights = marks[~asked], weight[~asked]
        right_blocks = tables.blocks(right)
        upto = choice[-1] + 1
        for at in range(0, int(asked.sum()), STRIP):
            left = marks[asked][at : at + STRIP]
            apart = sum(
                np.bitwise_count(left[:, i][:, None] ^ right[:, i][None, :]).astype(np.int16)
                for i in range(BITS // 64)
            )
            near = (apart <= radius) & (apart > 0)
            i, j = np.nonzero(near)
            # of the tables that a pair shares, the first has its first agreeing blocks
            agree = tables.blocks(left)[i, :upto] == right_blocks[j, :upto]
            near[i, j] = agree.sum(axis=1) == len(choice)
            yield left, right, weights, apart, near


def _sides(queries: DataFrame, marks: DataFrame, radius: int) -> tuple[DataFrame, Tables]:
    spark = marks.sparkSession
    bound_batches(spark)

    def different(frame: DataFrame, asked: bool) -> DataFrame:
        hi, lo = lanes(F.col("fingerprint"))
        rows = frame.where("fingerprint is not null").select(hi.alias("hi"), lo.alias("lo"))
        counted = rows.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("weight"))
        return counted.select(F.lit(asked).alias("asked"), "hi", "lo", "weight")

    rows = materialize(different(queries, True).unionByName(different(marks, False)), "marks")
    sizes = {r["asked"]: r["n"] for r in rows.groupBy("asked").agg(F.count("*").alias("n")).collect()}
    used = blocks_used(sizes.get(True, 0), sizes.get(False, 0), radius)
    return rows, Tables(radius, used)


def near_fingerprints(queries: DataFrame, marks: DataFrame, radius: int = 3) -> DataFrame:
    """(fingerprint, near, distance): every pair of different fingerprints within ``radius``.

    Both inputs have a ``fingerprint`` column; equal ones count once.
    """
    rows, tables = _sides(queries, marks, radius)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for left, right, _, apart, near in _found(batches, tables, radius):
            i, j = np.nonzero(near)
            halves = np.concatenate([left[i], right[j]], axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(halves[:, c]) for c in range(4)), pa.array(apart[i, j].astype(np.int32))],
                names=["hi", "lo", "near_hi", "near_lo", "distance"],
            )

    found = _dealt(rows, tables).mapInArrow(
        compare, "hi bigint, lo bigint, near_hi bigint, near_lo bigint, distance int"
    )
    return found.select(
        digits("hi", "lo").alias("fingerprint"), digits("near_hi", "near_lo").alias("near"), "distance"
    )


def count_near(queries: DataFrame, marks: DataFrame, radius: int = 3) -> DataFrame:
    """(fingerprint, n_near, nearest) of the queries with other fingerprints within ``radius``.

    ``n_near`` counts the rows of ``marks`` with other fingerprints; ``nearest`` is the
    least distance. Pairs are counted where they meet, so none is moved.
    """
    rows, tables = _sides(queries, marks, radius)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for left, _, weights, apart, near in _found(batches, tables, radius):
            some = near.any(axis=1)
            halves = left[some].view(np.int64)
            counts = near[some] @ weights
            least = np.where(near[some], apart[some], BITS + 1).min(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(halves[:, 0]),
                    pa.array(halves[:, 1]),
                    pa.array(counts.astype(np.int64)),
                    pa.array(least.astype(np.int32)),
                ],
                names=["hi", "lo", "n", "least"],
            )

    found = _dealt(rows, tables).mapInArrow(compare, "hi bigint, lo bigint, n bigint, least int")
    found = found.groupBy("hi", "lo").agg(F.sum("n").alias("n_near"), F.min("least").alias("nearest"))
    return found.select(digits("hi", "lo").alias("fingerprint"), "n_near", "nearest")
