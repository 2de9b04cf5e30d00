"""Exact self-join of documents on the Jaccard distance of their shingle sets.

Texts with equal sets are one node. The join runs through regions of the metric space:

1. Regions of single shingles. In one order of all shingles (frequent ones last and by
   frequency, others by hash) a set is filed under its first n - ceil(t n) + 1 shingles; two sets with
   similarity t or more meet in one of these regions at least.
2. A region of few nodes is joined directly. The number of regions that two sets share
   bounds their overlap from above, so few pairs that are not linked go further.
3. A region of many nodes has a pivot of its own, its centre: the node with the fewest rare
   shingles. Nodes near enough to it are connected through it, so a group of copies with
   edits becomes a star. Nodes of different components go on: the region is parted into
   cells by size (distances to the empty set), nodes are replicated into the cells next
   to theirs, and pairs of a cell are taken if their distances to the centre differ by the
   radius or less (triangle inequality) and their sketches leave room for the overlap.

Pairs that remain are held against wide sketches, whose number of bits grows with the set,
as sketches of one width tell nothing of long texts. What these leave is compared shingle
by shingle, so links are exact; only links between nodes that are connected already may go
unlisted. Shingles are 64-bit hashes.

Words are what ASCII white space parts; A-Z are lower-cased. Texts without words, null
ones too, have an empty set and link with nothing. Rows with equal ids are separate
documents. Null ids stay null, and so does the name of a component without any other.
An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import bound_batches, quoted
from martkit.llm.fingerprints import mixed
from martkit.llm.graph import components
from martkit.operators.joins import lookup_join
from martkit.session import discard, materialize, shuffles_removed

# A shingle is frequent from so many documents on, or from one MOST_FREQUENT-th of all
# shingles, so that the list of frequent ones has a fixed bound. Tasks report what they
# see twice or more; the order decides on speed alone, so that is near enough.
FREQUENT = 32
MOST_FREQUENT = 2_000_000
# A region of at most so many nodes is joined directly.
DIRECT = 64
SALTS = 64
# Shingles gathered before frequent ones are counted.
GATHERED = 4_000_000
# The columns of a sketch.
SKETCH = [f"s{i}" for i in range(8)]
# Rows of a large region that one task holds against those replicated into its cells.
CELL_ROWS = 4096
LEAST_ID = -(1 << 63)


# Bytes of words that are hashed together, and of a word that is hashed by itself.
LOT, LONG_WORD = 1 << 20, 4096


class ShingleSets:
    """The set of a text as a sorted array of 64-bit hashes.

    A word's hash is a polynomial in its letters, each of which stands for a random number;
    all words of a text are hashed by the same few array operations.
    """

    def __init__(self, width: int):
        self.width = width
        codes = np.arange(256)
        # A-Z count as a-z
        letters = np.where((codes >= 65) & (codes <= 90), codes + 32, codes).astype(np.uint64)
        self.letter = mixed(letters, 0)
        self.in_word = ~np.isin(codes, [32, *range(9, 14)])
        base = np.full(LONG_WORD, 0x9E3779B97F4A7C13, dtype=np.uint64)
        base[0] = 1
        self.power = np.cumprod(base)

    def words(self, text: bytes) -> np.ndarray:
        """The hashes of all words, in order."""
        raw = np.frombuffer(text, dtype=np.uint8)
        inside = np.zeros(len(raw) + 2, dtype=bool)
        inside[1:-1] = self.in_word[raw]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, sizes = edges[::2], edges[1::2] - edges[::2]
        hashes = np.empty(len(starts), dtype=np.uint64)
        begin, total = 0, np.cumsum(np.minimum(sizes, LONG_WORD))
        while begin < len(starts):
            done = total[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(total, done + LOT, "right")))
            hashes[begin:end] = self._lot(raw, starts[begin:end], sizes[begin:end])
            begin = end
        for i in np.flatnonzero(sizes > LONG_WORD).tolist():
            from xxhash import xxh3_64_intdigest

            hashes[i] = xxh3_64_intdigest(text[starts[i] : starts[i] + sizes[i]].lower())
        return mixed(hashes + sizes.astype(np.uint64), 1)

    def _lot(self, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        sizes = np.minimum(sizes, LONG_WORD)
        before = np.cumsum(sizes) - sizes
        place = np.arange(int(sizes.sum())) - np.repeat(before, sizes)
        letters = self.letter[raw[np.repeat(starts, sizes) + place]]
        return np.add.reduceat(letters * self.power[place], before)

    def __call__(self, text: bytes | None) -> np.ndarray:
        hashes = self.words(text or b"")
        width = min(self.width, len(hashes))
        runs = len(hashes) - width + 1 if width else 0
        total = np.full(runs, width, dtype=np.uint64)
        for i in range(width):
            total = mixed(total + hashes[i : i + runs], i + 2)
        total.sort()
        if len(total) > 1:
            total = total[np.concatenate([[True], total[1:] != total[:-1]])]
        return total


def node_of(shingles: np.ndarray) -> int:
    from xxhash import xxh3_64_intdigest

    return int(np.uint64(xxh3_64_intdigest(shingles.tobytes())).astype(np.int64))


def sketch_of(shingles: np.ndarray) -> np.ndarray:
    """Of each of 512 classes of shingles whether the set holds an odd number, as 64-bit numbers."""
    counts = np.bincount((shingles >> np.uint64(55)).astype(np.int64), minlength=512)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def wide_sketch_of(shingles: np.ndarray, percent: int) -> bytes | None:
    """Parities as in a sketch, but of a power of two of classes that grows with the set.

    It is at least four times the number of shingles that may differ between two linked
    sets of this size; unlike ones differ in near half of the classes. None if a sketch has
    as many.
    """
    bits = (8 * len(shingles) * (100 - percent) // (100 + percent)).bit_length()
    if 1 << bits <= 64 * len(SKETCH):
        return None
    classes = (shingles & np.uint64((1 << bits) - 1)).astype(np.int64)
    counts = np.bincount(classes, minlength=1 << bits)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def least_wide_different(one: np.ndarray, other: np.ndarray) -> int:
    """As ``least_different``, by the bytes of wide sketches; the wider one is folded."""
    while len(one) > len(other):
        one = one[: len(one) // 2] ^ one[len(one) // 2 :]
    while len(other) > len(one):
        other = other[: len(other) // 2] ^ other[len(other) // 2 :]
    return int(np.bitwise_count(one ^ other).sum())


def least_different(one: str, other: str) -> Column:
    """The least number of shingles that only one of two sets holds, by their sketches.

    A class that one of them holds an odd and the other an even number of has one at least.
    """
    total = F.lit(0)
    for name in SKETCH:
        total = total + F.bit_count(F.col(one.format(name)).bitwiseXOR(F.col(other.format(name))))
    return total


def prefix_length(n: int, percent: int) -> int:
    return n + (-n * percent // 100) + 1 if n else 0


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def real_id() -> Column:
    """Null ids are least among keys, but name no component."""
    return F.when(F.col("key") != LEAST_ID, F.col("key"))


class JaccardJoin:
    """One join: ``docs`` with a key, a tie (hash of the text) and the text."""

    def __init__(self, docs: DataFrame, percent: int, width: int, key: str, text: str):
        bound_batches(docs.sparkSession)
        self.spark, self.percent, self.width = docs.sparkSession, percent, width
        self.docs = docs.select(
            F.coalesce(quoted(key).cast("bigint"), F.lit(LEAST_ID)).alias("key"),
            F.xxhash64(F.coalesce(quoted(text), F.lit(""))).alias("tie"),
            quoted(text).alias("text"),
        )
        self.members = self._members()
        self.nodes = self.members.where("n > 0").groupBy("node").agg(
            F.min(F.struct("key", "tie")).alias("first"),
            F.min(real_id()).alias("least"),
            F.first("n").alias("n"),
            *[F.first(name).alias(name) for name in SKETCH],
        )
        self.nodes = self.nodes.select("node", "n", *SKETCH, "least", "first.*")
        self.nodes = materialize(self.nodes, "jaccard-nodes")

    def _members(self) -> DataFrame:
        """(key, tie, node, n) of each document; frequent shingles and wide sketches on the way."""
        percent, width = self.percent, self.width

        def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sets, known, held, size = ShingleSets(width), set(), [], 0

            def rows(counted: bool, wides: list, *columns) -> pa.RecordBatch:
                arrays = [pa.array(np.asarray(c, dtype=np.int64)) for c in columns]
                flags = pa.array(np.full(len(columns[0]), counted))
                return pa.RecordBatch.from_arrays(
                    [flags, *arrays, pa.array(wides, pa.binary())],
                    names=["counted", "key", "tie", "node", "n", *SKETCH, "wide"],
                )

            def frequent() -> pa.RecordBatch:
                found, times = np.unique(np.concatenate(held), return_counts=True)
                found, times = signed(found[times > 1]), times[times > 1]
                none = np.zeros(len(found))
                wides = [None] * len(found)
                return rows(True, wides, none, none, found, times, *[none] * len(SKETCH))

            for batch in batches:
                nodes, ns, sketches, wides = [], [], [], []
                for body in batch.column(2).cast(pa.binary()).to_pylist():
                    shingles = sets(body)
                    nodes.append(node_of(shingles))
                    ns.append(len(shingles))
                    sketches.append(sketch_of(shingles))
                    wides.append(None)
                    if ns[-1] and nodes[-1] not in known:
                        wides[-1] = wide_sketch_of(shingles, percent)
                        known.add(nodes[-1])
                        held.append(shingles)
                        size += len(held[-1])
                bits = np.array(sketches, dtype=np.int64).reshape(-1, len(SKETCH)).T
                yield rows(False, wides, batch.column(0), batch.column(1), nodes, ns, *bits)
                if size > GATHERED:
                    yield frequent()
                    held, size = [], 0
            if held:
                yield frequent()

        schema = "counted boolean, key bigint, tie bigint, node bigint, n bigint"
        schema = ", ".join([schema, *[f"{name} bigint" for name in SKETCH], "wide binary"])
        every = materialize(self.docs.mapInArrow(profile, schema), "jaccard-profiles")
        members = every.where("not counted").drop("counted", "wide")
        self.wides = every.where("wide is not null").select("node", "n", "wide")
        total = members.agg(F.sum("n")).first()[0] or 0
        least = max(FREQUENT, total // MOST_FREQUENT)
        counts = every.where("counted").groupBy("node").agg(F.sum("n").alias("n"))
        # at most MOST_FREQUENT rows
        found = counts.where(F.col("n") >= least).toPandas()
        often = found["node"].to_numpy(dtype=np.int64).view(np.uint64)
        order = np.argsort(often)
        times = found["n"].to_numpy(dtype=np.int64)
        self.frequent = self.spark.sparkContext.broadcast((often[order], times[order]))
        return members

    def _regions(self) -> DataFrame:
        """Pairs of small regions, and rows of large ones (region, node, n, place as a, b, n_a, n_b)."""
        percent, width, frequent = self.percent, self.width, self.frequent

        def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sets, known = ShingleSets(width), set()
            often, times = frequent.value
            for batch in batches:
                out = []
                for body in batch.column(0).cast(pa.binary()).to_pylist():
                    shingles = sets(body)
                    n = len(shingles)
                    node = node_of(shingles)
                    if not n or node in known:
                        continue
                    known.add(node)
                    k = prefix_length(n, percent)
                    if len(often):
                        at = np.minimum(np.searchsorted(often, shingles), len(often) - 1)
                        hot = often[at] == shingles
                    else:
                        hot = np.zeros(n, dtype=bool)
                    rare = shingles[~hot][:k]
                    usual = shingles[hot]
                    if len(usual):
                        usual = usual[np.argsort(times[at[hot]], kind="stable")]
                    usual = usual[: k - len(rare)]
                    flags = np.arange(len(rare) + len(usual)) >= len(rare)
                    out.append((np.concatenate([rare, usual]), flags, node, n))
                if out:
                    lengths = [len(o[0]) for o in out]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(signed(np.concatenate([o[0] for o in out]))),
                            pa.array(np.repeat([o[2] for o in out], lengths)),
                            pa.array(np.repeat([o[3] for o in out], lengths).astype(np.int32)),
                            pa.array(np.concatenate([np.arange(x, dtype=np.int32) for x in lengths])),
                            pa.array(np.concatenate([o[1] for o in out])),
                        ],
                        names=["region", "node", "n", "place", "hot"],
                    )

        names = ["large", "a", "b", "n_a", "n_b"]

        def batch_of(large: bool, a, b, n_a, n_b) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(a), large)),
                    pa.array(a),
                    pa.array(b),
                    pa.array(n_a.astype(np.int32)),
                    pa.array(n_b.astype(np.int32)),
                ],
                names=names,
            )

        def join_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rest: list[np.ndarray] | None = None
            running = None  # the region known to be large that rows may go on with

            def pairs(region, node, n, place, last: bool):
                """Join all regions but, unless ``last``, the last; return what is left."""
                nonlocal running
                fresh = np.ones(len(region), dtype=bool)
                fresh[1:] = (region[1:] != region[:-1]) | (node[1:] != node[:-1])
                region, node, n, place = region[fresh], node[fresh], n[fresh], place[fresh]
                starts = np.flatnonzero(np.concatenate([[True], region[1:] != region[:-1]]))
                sizes = np.diff(np.append(starts, len(region)))
                big = sizes > DIRECT
                if running is not None and len(region):
                    big[0] |= region[0] == running
                left = None
                if not last:
                    if big[-1]:
                        running = region[-1]
                    else:
                        left = [x[starts[-1] :] for x in (region, node, n, place)]
                        starts, sizes, big = starts[:-1], sizes[:-1], big[:-1]
                out = []
                if big.any():
                    rows = np.concatenate(
                        [np.arange(s, s + z) for s, z in zip(starts[big], sizes[big])]
                    )
                    out.append(batch_of(True, region[rows], node[rows], n[rows], place[rows]))
                for size in np.unique(sizes[~big]):
                    if size < 2:
                        continue
                    i, j = np.triu_indices(size, 1)
                    first = starts[~big & (sizes == size)][:, None]
                    x, y = (first + i).ravel(), (first + j).ravel()
                    small, great = np.minimum(n[x], n[y]), np.maximum(n[x], n[y])
                    fit = small.astype(np.int64) * 100 >= great.astype(np.int64) * percent
                    x, y = x[fit], y[fit]
                    out.append(batch_of(False, node[x], node[y], n[x], n[y]))
                return out, left

            for batch in batches:
                region, node = (batch.column(i).to_numpy() for i in (0, 1))
                n, place = (batch.column(i).to_numpy() for i in (2, 3))
                hot = batch.column(4).to_numpy(zero_copy_only=False)
                columns = (region, node, n, place)
                if hot.any():
                    yield batch_of(True, *(c[hot] for c in columns))
                    columns = tuple(c[~hot] for c in columns)
                if rest is not None:
                    columns = tuple(np.concatenate(both) for both in zip(rest, columns))
                if len(columns[0]):
                    out, rest = pairs(*columns, last=False)
                    yield from out
            if rest is not None:
                out, _ = pairs(*rest, last=True)
                yield from out

        rows = self.docs.select("text").mapInArrow(
            file, "region bigint, node bigint, n int, place int, hot boolean"
        )
        # rows of frequent shingles only pass through here, so they may go anywhere
        salt = F.when(F.col("hot"), F.pmod("node", F.lit(SALTS))).otherwise(0)
        rows = rows.repartition("region", salt).sortWithinPartitions("hot", "region", "node")
        schema = "large boolean, a bigint, b bigint, n_a int, n_b int"
        return materialize(rows.mapInArrow(join_regions, schema), "jaccard-regions")

    def _direct_pairs(self, regions: DataFrame, large: DataFrame) -> DataFrame:
        """Pairs of small regions whose overlap may still be large enough."""
        pairs = regions.where("not large").groupBy(
            F.least("a", "b").alias("a"),
            F.greatest("a", "b").alias("b"),
            F.when(F.col("a") < F.col("b"), F.col("n_a")).otherwise(F.col("n_b")).alias("n_a"),
            F.when(F.col("a") < F.col("b"), F.col("n_b")).otherwise(F.col("n_a")).alias("n_b"),
        )
        pairs = pairs.agg(F.count(F.lit(1)).alias("shared"))
        # regions of many nodes that both may share besides
        more = large.groupBy("node").agg(F.count(F.lit(1)).alias("more"))
        for side in ("a", "b"):
            pairs = pairs.join(
                more.select(F.col("node").alias(side), F.col("more").alias(f"more_{side}")),
                side,
                "left",
            )
        shared = F.col("shared") + F.least(
            F.coalesce("more_a", F.lit(0)), F.coalesce("more_b", F.lit(0))
        )

        def after(n: str):
            """Shingles behind those that a set is filed under."""
            return F.ceil(F.col(n) * self.percent / 100) - 1

        # the set whose filed shingles end first has no more than these beyond
        most = shared + F.greatest(after("n_a"), after("n_b"))
        needed = (F.col("n_a") + F.col("n_b")) * self.percent
        pairs = pairs.where(most * (100 + self.percent) >= needed).select("a", "b", "n_a", "n_b")
        for side in ("a", "b"):
            sketches = [F.col(c).alias(f"{c}_{side}") for c in SKETCH]
            pairs = pairs.join(self.nodes.select(F.col("node").alias(side), *sketches), side)
        return pairs.where(self._alike("{}_a", "{}_b", F.col("n_a") + F.col("n_b"))).select("a", "b")

    def _alike(self, one: str, other: str, sizes: Column) -> Column:
        """Whether sketches leave room for a link of sets with so many shingles together."""
        different = least_different(one, other) * (100 + self.percent)
        return different <= sizes * (100 - self.percent)

    def _likely(self, pairs: DataFrame) -> DataFrame:
        """The pairs less those whose wide sketches leave no room for a link."""
        percent = self.percent
        wides = self.wides.join(self._nodes_of(pairs), "node", "left_semi")
        wides = materialize(wides.dropDuplicates(["node"]), "jaccard-wides")
        for side in ("a", "b"):
            own = [F.col(c).alias(f"{c}_{side}") for c in ("n", "wide")]
            pairs = pairs.join(wides.select(F.col("node").alias(side), *own), side, "left")

        def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                room = np.ones(batch.num_rows, dtype=bool)
                sizes, *sides = (batch.column(i) for i in (2, 3, 4))
                for i, (n, x, y) in enumerate(zip(sizes.to_pylist(), *sides)):
                    if n is None:  # one of the sets has no wide sketch
                        continue
                    x, y = (np.frombuffer(s.as_buffer(), dtype=np.uint8) for s in (x, y))
                    different = least_wide_different(x, y)
                    room[i] = different * (100 + percent) <= n * (100 - percent)
                yield batch.select([0, 1]).filter(pa.array(room))

        sizes = (F.col("n_a") + F.col("n_b")).alias("n")
        pairs = pairs.select("a", "b", sizes, "wide_a", "wide_b")
        likely = materialize(pairs.mapInArrow(test, "a bigint, b bigint"), "jaccard-likely")
        discard(wides)
        return likely

    def _nodes_of(self, pairs: DataFrame) -> DataFrame:
        nodes = pairs.select(F.col("a").alias("node"))
        return nodes.unionByName(pairs.select(F.col("b").alias("node"))).distinct()

    def _verify(self, pairs: DataFrame) -> DataFrame:
        """(a, b, common, either) of the pairs that may be linked, from whole sets."""
        width = self.width
        pairs = self._likely(materialize(pairs, "jaccard-pairs"))
        wanted = self._nodes_of(pairs)
        wanted = materialize(wanted.join(self.nodes, "node").select("key", "tie", "node"), "wanted")
        # of copies of one text under one id, one is enough
        wanted = wanted.dropDuplicates(["key", "tie"])
        texts = lookup_join(self.docs, wanted, ["key", "tie"], "inner").select("node", "text")

        def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # a task sends the set of repeated rows once; what is left of copies does no harm
            sets, known = ShingleSets(width), set()
            for batch in batches:
                nodes = batch.column(0).to_pylist()
                fresh = []
                for i, node in enumerate(nodes):
                    if node not in known:
                        known.add(node)
                        fresh.append(i)
                bodies = batch.column(1).take(pa.array(fresh, pa.int64())).cast(pa.binary())
                packed = pa.array([sets(b).tobytes() for b in bodies.to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([nodes[i] for i in fresh], pa.int64()), packed],
                    names=["node", "packed"],
                )

        sets = texts.mapInArrow(collect, "node bigint, packed binary")
        sets = materialize(sets, "jaccard-sets")
        both = pairs.join(sets.select(F.col("node").alias("a"), F.col("packed").alias("set_a")), "a")
        both = both.join(sets.select(F.col("node").alias("b"), F.col("packed").alias("set_b")), "b")

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                common, either = [], []
                for x, y in zip(batch.column(2), batch.column(3)):
                    x = np.frombuffer(x.as_buffer(), dtype=np.uint64)
                    y = np.frombuffer(y.as_buffer(), dtype=np.uint64)
                    same = len(np.intersect1d(x, y, assume_unique=True))
                    common.append(same)
                    either.append(len(x) + len(y) - same)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(common), pa.array(either)],
                    names=["a", "b", "common", "either"],
                )

        both = both.select("a", "b", "set_a", "set_b")
        tested = both.mapInArrow(compare, "a bigint, b bigint, common bigint, either bigint")
        tested = materialize(tested, "jaccard-tested")
        discard(sets)
        return tested

    def _linked(self, tested: DataFrame) -> DataFrame:
        return tested.where(F.col("common") * 100 >= F.col("either") * self.percent).select("a", "b")

    def links(self) -> DataFrame:
        """(node, component) of the nodes that are linked with any other.

        First each node is compared with the centres of its large regions and with one
        partner of its small ones, which connects most copies; after that only nodes of
        different components.
        """
        regions = self._regions()
        large = regions.where("large").select(
            F.col("a").alias("region"),
            F.col("b").alias("node"),
            F.col("n_a").alias("n"),
            F.col("n_b").alias("place"),
        )
        large = large.distinct().join(self.nodes.select("node", *SKETCH), "node")
        large = materialize(large, "jaccard-large")
        direct = materialize(self._direct_pairs(regions, large), "jaccard-direct")
        discard(regions)

        # the centre has the fewest rare shingles, so copies with edits are all near it
        centre = F.min(F.struct("place", F.xxhash64("node").alias("tie"), "node", "n", *SKETCH))
        centres = large.groupBy("region").agg(centre.alias("c")).select(
            "region", *[F.col(f"c.{c}").alias(f"other_{c}") for c in ("node", "n", "place", *SKETCH)]
        )
        centres = materialize(centres, "jaccard-centres")
        near = lookup_join(large, centres, ["region"], "inner").where(self._possible())
        near = near.where("node <> other_node").select(*self._pair())
        one = direct.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
        tested = self._verify(near.unionByName(one).distinct())
        named = components(self._linked(tested))

        rest = self._apart(direct, named)
        across = self._across(large, named, centres, tested)
        again = self._verify(rest.unionByName(across).distinct())

        # what is linked now are components
        edges = self._linked(again)
        for side in ("a", "b"):
            cells = named.select(F.col("node").alias(side), F.col("component").alias("cell"))
            edges = edges.join(cells, side, "left").withColumn(side, F.coalesce("cell", side))
            edges = edges.drop("cell")
        joined = components(edges)
        final = joined.select(F.col("node").alias("component"), F.col("component").alias("to"))
        old = named.join(final, "component", "left")
        old = old.select("node", F.coalesce("to", "component").alias("component"))
        new = joined.join(named.select("node"), "node", "left_anti")
        return materialize(old.unionByName(new), "jaccard-components")

    def _apart(self, pairs: DataFrame, named: DataFrame) -> DataFrame:
        """The pairs whose nodes are in different components."""
        for side in ("a", "b"):
            cells = named.select(F.col("node").alias(side), F.col("component").alias(f"cell_{side}"))
            pairs = pairs.join(cells, side, "left")
        apart = F.coalesce("cell_a", "a") != F.coalesce("cell_b", "b")
        return pairs.where(apart).select("a", "b")

    def _possible(self) -> Column:
        """Whether a row and another of its region (``other_``) may be near enough.

        Sizes bound the similarity (the empty set is a pivot of all sets); in the first
        region that two sets share nothing before it is common; and sketches bound what is.
        """
        n, other = F.col("n"), F.col("other_n")
        needed = (n + other) * self.percent
        size = F.least(n, other) * 100 >= F.greatest(n, other) * self.percent
        most = F.least(n - F.col("place"), other - F.col("other_place"))
        alike = self._alike("{}", "other_{}", n + other)
        return size & (most * (100 + self.percent) >= needed) & alike

    def _pair(self) -> list[Column]:
        sides = ("node", "other_node")
        return [F.least(*sides).alias("a"), F.greatest(*sides).alias("b")]

    def _across(
        self, large: DataFrame, named: DataFrame, centres: DataFrame, tested: DataFrame
    ) -> DataFrame:
        """Pairs of large regions whose nodes are in different components.

        A region is parted into cells: by size, as the empty set is a pivot to which distance
        is a matter of size alone. Nodes are replicated into the neighbouring cells, which a
        partner may lie in; all pairs of a cell whose distances to the region's centre are
        within the radius of one another, and that are possible, are taken. Of two nodes the
        one with fewer rare shingles before the region's own has to have so few that it
        could meet a set as large as itself, so only such nodes are replicated.
        """
        rows = large.join(named, "node", "left")
        rows = rows.withColumn("cell", F.coalesce("component", "node")).drop("component")
        seen = rows.groupBy("region").agg(
            F.min("cell").alias("x"), F.max("cell").alias("y"), F.count(F.lit(1)).alias("held")
        )
        salts = F.ceil(F.col("held") / CELL_ROWS).cast("int").alias("salts")
        several = seen.where("x < y").select("region", salts)
        several = materialize(several, "jaccard-several")
        rows = lookup_join(rows, several, ["region"], "inner")

        known = tested.select("a", "b", (1 - F.col("common") / F.col("either")).alias("d"))
        turned = known.select(F.col("b").alias("node"), F.col("a").alias("centre"), "d")
        known = known.select(F.col("a").alias("node"), F.col("b").alias("centre"), "d")
        known = known.unionByName(turned)
        rows = lookup_join(
            rows, centres.select("region", F.col("other_node").alias("centre")), ["region"], "inner"
        )
        rows = rows.join(known, ["node", "centre"], "left")
        # what was compared with the centre is done
        rows = rows.where(F.col("node") != F.col("centre")).drop("centre")
        step = float(np.log(100 / self.percent) * (1 + 1e-6)) if self.percent < 100 else 1e-6
        rows = rows.withColumns(
            {
                "size": F.floor(F.log("n") / step),
                "strong": (F.col("n") - F.col("place")) * (100 + self.percent)
                >= F.col("n") * 2 * self.percent,
            }
        )
        rows = materialize(rows, "jaccard-open")

        left = rows.withColumn("salt", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int"))
        others = ("node", "n", "place", *SKETCH, "cell", "d", "strong")
        copies = F.explode(F.sequence(F.lit(0), F.col("salts") - 1))
        windows = F.explode(F.array(*[F.col("size") + i for i in (-1, 0, 1)]))
        right = rows.where("strong").select(
            "region", windows.alias("size"), *[F.col(c).alias(f"other_{c}") for c in others], "salts"
        )
        right = right.withColumn("salt", copies).drop("salts")
        radius = 1 - self.percent / 100 + 1e-9
        window = F.coalesce(F.abs(F.col("d") - F.col("other_d")) <= radius, F.lit(True))
        # a pair of strong nodes is taken once
        once = ~F.col("strong") | (F.col("node") > F.col("other_node"))
        apart = F.col("cell") != F.col("other_cell")
        pairs = left.join(right, ["region", "size", "salt"])
        pairs = pairs.where(apart & once & window & self._possible())
        return pairs.select(*self._pair()).distinct()


def jaccard_components(
    docs: DataFrame,
    percent: int = 85,
    width: int = 4,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document.

    Two documents are linked when 100 * |both| >= percent * |either|. A component is named
    by the least id among its documents.
    """
    with shuffles_removed(docs.sparkSession):
        join = JaccardJoin(docs, percent, width, key, text)
        named = join.links()
        # the least id of each component, by way of the least id of each node
        least = join.nodes.join(named, "node", "left")
        least = least.withColumn("component", F.coalesce("component", "node"))
        names = least.groupBy("component").agg(F.min("least").alias("least"))
        lookup = least.drop("least").join(names, "component").select("node", "least")
        lookup = materialize(lookup, "jaccard-names")
    found = lookup_join(join.members, lookup, ["node"], "left")
    return found.select(
        real_id().alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.coalesce("least", real_id()).alias("component_id"),
    )
