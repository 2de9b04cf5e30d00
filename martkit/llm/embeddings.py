"""Near-duplicate embeddings by iterative quantisation.

Rotations are learned on a bounded sample so that the signs of a rotated vector make
balanced binary codes that keep angles. A code is cut into short pieces, one Hamming
table for each; vectors that agree in a piece meet in its bucket, are compared by their
whole codes, and what is near there is compared by cosine of the original vectors in
double precision. Every vector is filed in every table.

Equal vectors are one node with a weight. Buckets of many nodes are split into blocks,
and every two blocks meet in a task of their own. A pair is taken up in the first table
that it shares, so it is compared once.

Vectors that are null, empty, zero, or hold null or non-finite components link with
nothing; so do vectors of different lengths with each other. An empty table gives no
rows. Rows with equal ids are answered one by one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import bound_batches, quoted
from martkit.llm.graph import components
from martkit.operators.joins import lookup_join
from martkit.session import materialize

# Vectors that rotations are learned on, at most about so many.
SAMPLE = 4096
ITERATIONS = 30
# Share of pairs at the very threshold that shall meet in some table.
RECALL = 0.985
# Nodes that a bucket of random codes holds on average.
BUCKET = 16
# Nodes of one block of a large bucket.
BLOCK = 2048
# Codes of a pair at the threshold differ in a binomial number of bits; pairs beyond the
# mean by so many standard deviations are not compared.
DEVIATIONS = 4.0
STRIP = 256
# Bits of a code that go along with a vector to each of its tables; so what is filed grows
# with the tables, not with their square.
KEPT_BITS = 512


@dataclass
class Codes:
    """Rotations, and how their signs are cut into tables."""

    rotations: np.ndarray  # (dimensions, bits)
    width: int
    radius: int  # of the bits that are kept
    kept: int  # tables whose pieces go along, all if these are few

    @property
    def tables(self) -> int:
        return self.rotations.shape[1] // self.width

    def encode(self, rows: np.ndarray) -> np.ndarray:
        """One number of ``width`` bits for each table."""
        bits = (rows @ self.rotations > 0).reshape(len(rows), -1, self.width)
        return bits @ (1 << np.arange(self.width, dtype=np.int64))

    def pack(self, pieces: np.ndarray) -> np.ndarray:
        """The kept pieces as rows of 64-bit numbers."""
        bits = pieces[:, : self.kept, None] >> np.arange(self.width, dtype=np.int64) & 1
        bits = bits.reshape(len(pieces), -1).astype(np.uint8)
        lanes = np.zeros((len(pieces), -(-bits.shape[1] // 64) * 64), dtype=np.uint8)
        lanes[:, : bits.shape[1]] = bits
        return np.packbits(lanes, axis=1).view(np.uint64)

    def unpack(self, lanes: np.ndarray) -> np.ndarray:
        """The kept pieces again."""
        bits = np.unpackbits(lanes.view(np.uint8), axis=1)[:, : self.kept * self.width]
        bits = bits.reshape(len(lanes), self.kept, self.width)
        return bits @ (1 << np.arange(self.width, dtype=np.int64))


def rotation(rows: np.ndarray, rng: np.random.Generator, rounds: int = ITERATIONS) -> np.ndarray:
    """Principal directions, rotated so that signs are as near to the data as can be."""
    size = rows.shape[1]
    _, _, axes = np.linalg.svd(rows, full_matrices=True)
    axes = axes.T[:, :size]
    spun, _ = np.linalg.qr(rng.standard_normal((size, size)))
    projected = rows @ axes
    for _ in range(rounds):
        signs = np.where(projected @ spun > 0, 1.0, -1.0)
        u, _, v = np.linalg.svd(projected.T @ signs)
        spun = u @ v
    return axes @ spun


def fit_codes(rows: np.ndarray, nodes: int, cosine: float, seed: int = 5) -> Codes:
    """Codes for ``nodes`` unit vectors of which ``rows`` are a sample."""
    rng = np.random.default_rng(seed)
    differ = math.acos(min(1.0, max(-1.0, cosine))) / math.pi
    width = min(40, max(8, math.ceil(math.log2(max(nodes, 2) / BUCKET))))
    meet = (1 - differ) ** width
    tables = max(1, math.ceil(math.log(1 - RECALL) / math.log1p(-meet))) if meet < 1 else 1
    bits, size = width * tables, rows.shape[1]
    found = [rotation(rows, rng) for _ in range(-(-bits // size))]
    kept = min(tables, max(1, KEPT_BITS // width))
    mean = kept * width * differ
    # bits of more than one rotation of a short vector depend on one another
    spread = math.sqrt(mean * (1 - differ)) * math.sqrt(max(1.0, kept * width / size))
    radius = math.ceil(mean + DEVIATIONS * spread)
    return Codes(np.concatenate(found, axis=1)[:, :bits], width, min(kept * width, radius), kept)


def unit_vector(values: list[float | None] | None) -> np.ndarray | None:
    if not values or any(v is None for v in values):
        return None
    row = np.array(values, dtype=np.float64)
    if not np.isfinite(row).all():
        return None
    largest = np.abs(row).max()
    if not largest:
        return None
    row /= largest
    return row / math.sqrt(float(row @ row))


def _blocks(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[pa.Array]]:
    """Columns of each run of equal keys; rows come sorted by the first ``keys`` columns."""
    rest: list[pa.Array] | None = None

    def cut(columns: list[pa.Array], start: int, end: int) -> list[pa.Array]:
        return [c.slice(start, end - start) for c in columns]

    for batch in batches:
        columns = list(batch.columns)
        if rest is not None:
            columns = [pa.concat_arrays([r, c]) for r, c in zip(rest, columns)]
        if not len(columns[0]):
            continue
        heads = np.stack([c.to_numpy(zero_copy_only=False) for c in columns[:keys]], axis=1)
        cuts = np.flatnonzero((heads[1:] != heads[:-1]).any(axis=1)) + 1
        edges = [0, *cuts.tolist(), len(heads)]
        for start, end in zip(edges[:-2], edges[1:-1]):
            if end - start > 1:
                yield cut(columns, start, end)
        rest = cut(columns, edges[-2], edges[-1])
    if rest is not None and len(rest[0]) > 1:
        yield rest


def near_pairs(vectors: DataFrame, codes: Codes) -> DataFrame:
    """(a, b) of nodes that share a table and are near by the kept bits of their codes.

    A pair is reported by the first kept table that it shares, or by others that it
    shares if it shares none of the kept ones; these few are made distinct.
    """
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(codes)
    tables, kept = codes.tables, codes.kept

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = batch.column(1).to_pylist()
            rows = np.array([np.frombuffer(p, dtype="<f8") for p in packed])
            if not len(rows):
                continue
            found = shared.value.encode(rows)
            whole = [c.tobytes() for c in shared.value.pack(found)]
            node = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.tile(np.arange(tables, dtype=np.int32), len(node))),
                    pa.array(found.ravel()),
                    pa.array(np.repeat(node, tables)),
                    pa.array([w for w in whole for _ in range(tables)], pa.binary()),
                ],
                names=["place", "piece", "node", "code"],
            )

    filed = vectors.select("node", "packed").mapInArrow(
        file, "place int, piece bigint, node bigint, code binary"
    )
    filed = materialize(filed, "codes")
    sizes = filed.groupBy("place", "piece").agg(F.count(F.lit(1)).alias("n"))
    full = sizes.where(F.col("n") > BLOCK)
    full = full.select("place", "piece", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    filed = lookup_join(filed, materialize(full, "full-buckets"), ["place", "piece"], "left")
    blocks = F.coalesce("blocks", F.lit(1))
    filed = filed.withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    filed = filed.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    filed = filed.select(
        "place",
        "piece",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        "own",
        "node",
        "code",
    )
    dealt = filed.repartition("place", "piece", "low", "high")
    dealt = dealt.sortWithinPartitions("place", "piece", "low", "high")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        radius = shared.value.radius
        for columns in _blocks(batches, 4):
            place, low, high = (columns[i][0].as_py() for i in (0, 2, 3))
            own, node = (columns[i].to_numpy() for i in (4, 5))
            code = np.array([np.frombuffer(c, dtype=np.uint64) for c in columns[6].to_pylist()])
            pieces = np.ascontiguousarray(shared.value.unpack(code)[:, :place].T)
            left = np.flatnonzero(own == low)
            right = left if low == high else np.flatnonzero(own == high)
            for at in range(0, len(left), STRIP):
                rows = left[at : at + STRIP]
                apart = np.zeros((len(rows), len(right)), dtype=np.int32)
                for lane in range(code.shape[1]):
                    apart += np.bitwise_count(code[rows, lane][:, None] ^ code[right, lane][None, :])
                good = apart <= radius
                # of a block with itself each pair once
                if low == high:
                    good &= np.arange(len(right))[None, :] > (at + np.arange(len(rows)))[:, None]
                i, j = np.nonzero(good)
                i, j = rows[i], right[j]
                for piece in pieces:
                    fresh = piece[i] != piece[j]
                    i, j = i[fresh], j[fresh]
                a, b = node[i], node[j]
                if len(a):
                    ends = [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))]
                    yield pa.RecordBatch.from_arrays(ends, names=["a", "b"])

    pairs = dealt.mapInArrow(compare, "a bigint, b bigint")
    return pairs if kept == tables else pairs.distinct()


def link_embeddings(
    rows: DataFrame, cosine: float = 0.9, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per vector."""
    spark = rows.sparkSession
    bound_batches(spark)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        known = set()
        for batch in batches:
            nodes, packed, sizes = [], [], []
            for values in batch.column(1).to_pylist():
                row = unit_vector(values)
                if row is None:
                    nodes.append(None)
                    packed.append(None)
                    sizes.append(None)
                    continue
                raw = np.array(values, dtype="<f8").tobytes()
                nodes.append(int(np.uint64(xxh3_64_intdigest(raw)).astype(np.int64)))
                # the vector itself is sent once by each task
                packed.append(None if nodes[-1] in known else row.astype("<f8").tobytes())
                sizes.append(len(row))
                known.add(nodes[-1])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(nodes, pa.int64()),
                    pa.array(packed, pa.binary()),
                    pa.array(sizes, pa.int32()),
                ],
                names=["vec_id", "node", "packed", "size"],
            )

    read_rows = rows.select(
        quoted(key).cast("bigint").alias("vec_id"),
        quoted(vector).cast("array<double>").alias("embedding"),
    )
    schema = "vec_id bigint, node bigint, packed binary, size int"
    every = materialize(read_rows.mapInArrow(read, schema), "vectors")
    weights = every.where("node is not null").groupBy("node").agg(
        F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least")
    )
    weights = materialize(weights, "vector-weights")
    vectors = every.where("packed is not null").dropDuplicates(["node"])
    vectors = materialize(vectors.select("node", "size", "packed"), "vector-nodes")

    links = None
    sizes = [r["size"] for r in vectors.select("size").distinct().collect()]
    for size in sorted(sizes):
        same = vectors.where(F.col("size") == size)
        n = same.count()
        chance = min(1.0, SAMPLE / n)
        drawn = F.pmod(F.xxhash64("node", F.lit(17)), F.lit(1 << 30)) < int(chance * (1 << 30)) + 1
        sample = same.where(drawn).orderBy("node").select("packed").collect()
        fitted = np.array([np.frombuffer(r["packed"], dtype="<f8") for r in sample])
        if not len(fitted):
            fitted = np.eye(size)
        pairs = near_pairs(same, fit_codes(fitted, n, cosine))
        pairs = materialize(pairs, "vector-pairs")
        for side in ("a", "b"):
            own = same.select(F.col("node").alias(side), F.col("packed").alias(f"packed_{side}"))
            pairs = pairs.join(own, side)

        def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                x, y = (
                    np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype="<f8").reshape(
                        batch.num_rows, -1
                    )
                    for i in (2, 3)
                )
                good = np.einsum("ij,ij->i", x, y) >= cosine
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).filter(pa.array(good)) for i in (0, 1)], names=["a", "b"]
                )

        found = pairs.select("a", "b", "packed_a", "packed_b").mapInArrow(
            rerank, "a bigint, b bigint"
        )
        links = found if links is None else links.unionByName(found)

    if links is None:
        links = spark.createDataFrame([], "a bigint, b bigint")
    links = materialize(links, "vector-links")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    heavy = weights.select(F.col("node").alias("b"), "weight")
    degree = both.join(heavy, "b").groupBy("a").agg(F.sum("weight").alias("others"))
    nodes = weights.join(degree.withColumnRenamed("a", "node"), "node", "left")
    nodes = nodes.join(components(links), "node", "left")
    nodes = nodes.withColumn("component", F.coalesce("component", "node"))
    names = nodes.groupBy("component").agg(F.min("least").alias("first"))
    nodes = nodes.join(names, "component").select(
        "node",
        (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        "first",
    )
    out = lookup_join(
        every.select("vec_id", "node"), materialize(nodes, "vector-names"), ["node"], "left"
    )
    out = out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("first", "vec_id").alias("component_id"),
    )
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
