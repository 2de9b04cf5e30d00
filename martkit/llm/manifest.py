"""Merkle manifest of a dataset, kept as a postorder append log.

Leaves are hashes of rows; per tree (a language, say) they ascend by key, and every two
consecutive nodes become their parent until one, the subroot, remains. Subroots in order
of their tree's name are the leaves of one more tree, which gives the root.

A tree is built by aligned builders: builder ``b`` takes the leaves from ``b * 2**TIER`` on
and appends their nodes to a log of its own in the order in which they are completed, that
is, in postorder. The roots of builders are the leaves of the next tier. No builder sees
more than ``2**TIER`` leaves, whatever a tree holds. Where a node stands in the log follows
from sizes alone: all nodes that end at earlier leaves come before it, and of those that end
at its own last leaf the lower ones do (:func:`postorder`). So a proof needs no pointers:
the sibling of a node is addressed by its position, within a builder's log and in the whole.

Nulls: a null field is written as ``-``, a null tree name sorts first and is a tree of its
own, null keys sort first. Rows with one key are ordered by their leaf, and repeated rows
are leaves of their own, alike and so interchangeable; they may be spread over any number of
builders. An empty table has no rows to prove. Columns other than those named do not
matter, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martkit.llm.common import bound_batches, quoted
from martkit.operators.joins import lookup_join
from martkit.session import materialize

# A builder takes 2 ** TIER leaves.
TIER = 10

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

# Digests are stored as bytes and hashed as hex text.
DIGEST = 32


def leaf_hash(values: list[Column]) -> Column:
    """SHA-256 (hex) of values, each ``-`` if null, else its length in bytes, ``:`` and itself."""
    parts = []
    for value in values:
        shown = value.cast("string")
        size = F.octet_length(shown).cast("string")
        parts.append(F.coalesce(F.concat(size, F.lit(":"), shown), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def node_hash(digests: list[bytes]) -> bytes:
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def height(leaves: int) -> int:
    """Levels above the leaves of a tree."""
    return (leaves - 1).bit_length()


def postorder(level: int, index: int, leaves: int, levels: int) -> int:
    """Position, from 0, of a node in the postorder log of a tree with ``levels`` above its leaves.

    A node is complete when its last leaf is: before it stand the nodes of its own and lower
    levels that end there or earlier, and the nodes of higher levels that end earlier.
    """
    end = min((index + 1) << level, leaves)
    before = sum(_complete(end, k, leaves) for k in range(level + 1))
    return before + sum((end - 1) >> k for k in range(level + 1, levels + 1)) - 1


def _complete(end: int, level: int, leaves: int) -> int:
    """Nodes of a level that the first ``end`` leaves complete."""
    return (end >> level) + (end == leaves and end % (1 << level) > 0)


def append_nodes(leaves: list[bytes], levels: int) -> bytes:
    """The log of a builder: all nodes over its leaves, one after the other as completed.

    ``levels`` are built even if fewer would do, for a builder at the end of a tree may
    have fewer leaves than its neighbours, and its nodes then have one child each.
    """
    log = []
    open_nodes: list[list[bytes]] = [[] for _ in range(levels + 1)]
    for place, digest in enumerate(leaves):
        last = place + 1 == len(leaves)
        log.append(digest)
        open_nodes[0].append(digest)
        for level in range(levels):
            children = open_nodes[level]
            if len(children) < 2 and not (last and children):
                break
            parent = node_hash(children)
            open_nodes[level] = []
            log.append(parent)
            open_nodes[level + 1].append(parent)
    return b"".join(log)


def siblings_in(log: bytes, place: int, leaves: int, levels: int) -> Iterator[tuple[int, bytes]]:
    """(side, digest) of the siblings of a leaf in a builder's log, from below; side 0 is left.

    A node without a sibling gives side -1 and no digest.
    """
    for level in range(levels):
        index = place >> level
        other = index ^ 1
        if other << level >= leaves:
            yield -1, b""
        else:
            at = postorder(level, other, leaves, levels) * DIGEST
            yield other & 1, log[at : at + DIGEST]


def fold(digest: bytes, path: list[tuple[int, bytes]]) -> bytes:
    """The root that a leaf and its siblings give."""
    for side, sibling in path:
        pair = [digest] if side < 0 else [sibling, digest] if side == 0 else [digest, sibling]
        digest = node_hash(pair)
    return digest


def pack_path(path: list[tuple[int, bytes]]) -> bytes:
    """A path as bytes: each step is its side plus one, and the digest if there is one."""
    return b"".join(bytes([side + 1]) + digest for side, digest in path)


def unpack_path(packed: bytes) -> list[tuple[int, bytes]]:
    path, at = [], 0
    while at < len(packed):
        side = packed[at] - 1
        size = DIGEST if side >= 0 else 0
        path.append((side, packed[at + 1 : at + 1 + size]))
        at += 1 + size
    return path


@dataclass(frozen=True)
class Manifest:
    """The stored logs: ``tiers`` over the rows' trees, ``top`` over their subroots.

    Each is one row per builder: tree, block, n (leaves of its tree in this tier), leaves,
    log and root.
    """

    tiers: list[DataFrame]
    top: list[DataFrame]
    bits: int

    @property
    def root(self) -> str | None:
        """Of the whole dataset, as hex; None if it is empty."""
        row = self.top[-1].select(F.lower(F.hex("root"))).first()
        return row[0] if row else None


# -- ranks --------------------------------------------------------------------


def _ranked(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with (rank, n): the place in its ``tree`` by ``order``, and the tree's size.

    Rows are sorted by range, with a spread of equal ones as the last sort key, and numbered
    where they lie. Trees are then offset by the counts of the ranges before, of which
    there are as many as tasks; no task sees all rows of a tree.
    """
    spread = rows.withColumn("spread", F.monotonically_increasing_id())
    keys = ["tree", *order, "spread"]
    placed = spread.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("spread")
    # partition number and place in it
    placed = placed.withColumn("number", F.monotonically_increasing_id())
    placed = placed.withColumn("range", F.shiftright("number", 33).cast("int"))
    placed = materialize(placed, name)

    counts = placed.groupBy("tree", "range").agg(
        F.min("number").alias("first"), F.count(F.lit(1)).alias("rows")
    )
    before = Window.partitionBy("tree").orderBy("range")
    whole = Window.partitionBy("tree")
    counts = counts.select(
        "tree",
        "range",
        (F.sum("rows").over(before) - F.col("rows") - F.col("first")).alias("shift"),
        F.sum("rows").over(whole).alias("n"),
    )
    joined = lookup_join(placed, materialize(counts, f"{name}-counts"), ["tree", "range"], "inner")
    joined = joined.withColumn("rank", F.col("number") + F.col("shift"))
    return joined.drop("number", "range", "shift")


# -- builders -----------------------------------------------------------------


def _levels(n: int, bits: int) -> int:
    """Levels that a tier builds over a tree of ``n`` nodes."""
    return min(bits, height(n))


def _build(ranked: DataFrame, bits: int, carried: list[str], name: str) -> DataFrame:
    """One row per aligned builder of a tier, with its log. ``ranked``: tree, rank, n, leaf."""
    bound_batches(ranked.sparkSession)
    block = F.shiftright("rank", bits)
    leaf = F.struct("rank", "leaf", *carried)
    grouped = ranked.groupBy("tree", block.alias("block")).agg(
        F.first("n").alias("n"), F.array_sort(F.collect_list(leaf)).alias("leaves")
    )
    kinds = dict(grouped.dtypes)
    schema = f"tree string, block bigint, n bigint, leaves {kinds['leaves']}, log binary, root binary"

    def build(batches):
        for batch in batches:
            logs, roots = [], []
            for n, leaves in zip(batch.column("n").to_pylist(), batch.column("leaves")):
                digests = leaves.values.field("leaf").to_pylist()
                log = append_nodes(digests, _levels(n, bits))
                logs.append(log)
                roots.append(log[-DIGEST:])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(logs, pa.binary()), pa.array(roots, pa.binary())],
                names=[*batch.schema.names, "log", "root"],
            )

    return materialize(grouped.mapInArrow(build, schema), name)


def _tiers(ranked: DataFrame, bits: int, carried: list[str], name: str) -> list[DataFrame]:
    """Tiers of builders until every tree has one root.

    As many as the greatest tree needs, some four for 10**12 leaves. A tree that is done
    passes its root on as a tree of one leaf.
    """
    tiers = [_build(ranked, bits, carried, f"{name}-0")]
    while not tiers[-1].where("block > 0").isEmpty():
        below = tiers[-1]
        sizes = F.shiftright(F.col("n") - 1, bits) + 1
        nodes = below.select(
            "tree", F.col("block").alias("rank"), sizes.alias("n"), F.col("root").alias("leaf")
        )
        tiers.append(_build(nodes, bits, [], f"{name}-{len(tiers)}"))
    return tiers


def build_manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = FIELDS,
    tree: str = "lang",
    key: str = "doc_id",
    presented: Mapping[str, Column] | None = None,
    bits: int = TIER,
) -> Manifest:
    """Hash all rows and store the logs of all builders.

    ``presented`` gives fields other values, such as those of a copy to be verified; the hash
    of the row with these is kept beside its leaf where it differs.
    """
    # every tree has a name: "" is null's, others begin with "="
    named = F.coalesce(F.concat(F.lit("="), quoted(tree).cast("string")), F.lit(""))
    leaf = F.unhex(leaf_hash([quoted(f) for f in fields]))
    columns = [named.alias("tree"), quoted(key).alias("key"), leaf.alias("leaf")]
    shown = F.lit(None).cast("binary")
    if presented:
        other = [presented.get(f, quoted(f)) for f in fields]
        same = [~presented[f].eqNullSafe(quoted(f)) for f in fields if f in presented]
        changed = same[0]
        for one in same[1:]:
            changed = changed | one
        shown = F.when(changed, F.unhex(leaf_hash(other)))
    # stored first: dealing rows out by range looks at them twice
    rows = materialize(docs.select(*columns, shown.alias("presented")), "manifest-rows")
    ranked = _ranked(rows, ["key", "leaf"], "manifest-leaves")
    tiers = _tiers(ranked, bits, ["key", "presented"], "manifest")
    roots = tiers[-1].select(
        F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("leaf")
    )
    subroots = _ranked(roots, ["name"], "manifest-subroots")
    return Manifest(tiers, _tiers(subroots, bits, ["name"], "manifest-top"), bits)


# -- the log as a table -------------------------------------------------------


def log_entries(manifest: Manifest) -> DataFrame:
    """(tree, position, level, place, digest): the logs of all builders as one per tree.

    ``position`` is the place in the postorder of the whole tree; ``tree`` is "" for null and
    otherwise the name after "=". A builder's root is a leaf of the next tier and listed once.
    """
    bits, spark = manifest.bits, manifest.tiers[0].sparkSession
    leaves = manifest.tiers[0].groupBy("tree").agg(F.first("n").alias("total"))
    leaves = materialize(leaves, "manifest-sizes")
    parts = []
    for tier, builders in enumerate(manifest.tiers):
        logs = builders.select("tree", "block", "n", F.size("leaves").alias("own"), "log")
        parts.append(lookup_join(logs, leaves, ["tree"], "inner").withColumn("tier", F.lit(tier)))
    bound_batches(spark)
    schema = "tree string, position bigint, level int, place bigint, digest binary"

    def entries(batches):
        for batch in batches:
            for row in batch.to_pylist():
                found = _entries(row, bits)
                columns = list(zip(*found)) or [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["tree"]] * len(found), pa.string()),
                        *[pa.array(c, t) for c, t in zip(columns, _ENTRY_TYPES)],
                    ],
                    names=["tree", "position", "level", "place", "digest"],
                )

    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.mapInArrow(entries, schema)


_ENTRY_TYPES = (pa.int64(), pa.int32(), pa.int64(), pa.binary())


def _entries(row: dict, bits: int) -> list[tuple[int, int, int, bytes]]:
    """(position in the tree, level, index, digest) of the nodes of one builder."""
    levels = _levels(row["n"], bits)
    tall, low = height(row["total"]), row["tier"] * bits
    found = []
    for level in range(levels + 1):
        if level == 0 and row["tier"]:
            continue
        for place in range(-(-row["own"] // (1 << level))):
            at = postorder(level, place, row["own"], levels) * DIGEST
            index = (row["block"] << (bits - level)) + place
            position = postorder(low + level, index, row["total"], tall)
            found.append((position, low + level, index, row["log"][at : at + DIGEST]))
    return found


# -- proofs -------------------------------------------------------------------


def _paths(tiers: list[DataFrame], above: DataFrame, bits: int, name: str) -> DataFrame:
    """(tree, block, path, subroot) of the builders of the lowest tier.

    ``above``: (tree, path, subroot), the path from a tree's root upwards. From the top tier
    down every builder's root finds its siblings in the log of the builder above it. The
    paths are kept per builder and not per leaf.
    """
    paths = above.withColumn("block", F.lit(0).cast("bigint"))
    for tier in range(len(tiers) - 1, 0, -1):
        builders = tiers[tier].select("tree", "block", "n", F.size("leaves").alias("own"), "log")
        found = lookup_join(builders, paths, ["tree", "block"], "inner")
        schema = "tree string, block bigint, path binary, subroot binary"

        def extend(batches, bits=bits):
            for batch in batches:
                for row in batch.to_pylist():
                    levels = _levels(row["n"], bits)
                    own = range(row["own"])
                    first = row["block"] << bits
                    steps = [siblings_in(row["log"], i, row["own"], levels) for i in own]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row["tree"]] * len(own), pa.string()),
                            pa.array([first + i for i in own], pa.int64()),
                            pa.array([pack_path(list(s)) + row["path"] for s in steps], pa.binary()),
                            pa.array([row["subroot"]] * len(own), pa.binary()),
                        ],
                        names=["tree", "block", "path", "subroot"],
                    )

        paths = materialize(found.mapInArrow(extend, schema), f"{name}-paths-{tier}")
    return paths.select("tree", "block", "path", "subroot")


def prove(manifest: Manifest, with_siblings: bool = False) -> DataFrame:
    """One row per leaf: key, leaf, subroot, root, proof_sha256, folded_root and verified.

    ``proof_sha256`` hashes the siblings from leaf to root. ``folded_root`` is computed from
    what was presented, or else the leaf, and the siblings; ``verified`` tells if it is the
    root. ``with_siblings`` adds the proof itself: ``sides`` (0 left, 1 right, -1 none), one
    for each level, and the ``siblings`` that there are.
    """
    bits, root = manifest.bits, manifest.root
    spark = manifest.tiers[0].sparkSession
    bound_batches(spark)
    # a path from the subroots on, for every tree
    nothing = spark.createDataFrame([("", b"", None)], "tree string, path binary, subroot binary")
    top = _paths(manifest.top, nothing, bits, "manifest-top")
    lowest = manifest.top[0].select("tree", "block", "n", "leaves", "log")
    lowest = lookup_join(lowest, top, ["tree", "block"], "inner")

    def spell(batches):
        for batch in batches:
            for row in batch.to_pylist():
                levels = _levels(row["n"], bits)
                names, paths, roots = [], [], []
                for place, leaf in enumerate(row["leaves"]):
                    steps = siblings_in(row["log"], place, len(row["leaves"]), levels)
                    names.append(leaf["name"])
                    paths.append(pack_path(list(steps)) + row["path"])
                    roots.append(leaf["leaf"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, pa.string()),
                        pa.array(paths, pa.binary()),
                        pa.array(roots, pa.binary()),
                    ],
                    names=["tree", "path", "subroot"],
                )

    trees = lowest.mapInArrow(spell, "tree string, path binary, subroot binary")
    paths = _paths(manifest.tiers, materialize(trees, "manifest-trees"), bits, "manifest")
    builders = manifest.tiers[0].select("tree", "block", "n", "leaves", "log")
    found = lookup_join(builders, paths, ["tree", "block"], "inner")

    kind = dict(manifest.tiers[0].select(F.col("leaves")[0]["key"].alias("key")).dtypes)["key"]
    schema = (
        f"key {kind}, leaf string, subroot string, root string, proof_sha256 string, "
        "folded_root string, verified boolean"
    )
    if with_siblings:
        schema += ", sides array<int>, siblings array<string>"

    def extract(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                yield _proofs(batch.slice(at, 1), bits, root, with_siblings)

    return found.mapInArrow(extract, schema)


def _proofs(builder: pa.RecordBatch, bits: int, root: str, with_siblings: bool) -> pa.RecordBatch:
    """The rows of :func:`prove` for the leaves of one builder."""
    leaves = builder.column("leaves")[0].values
    log, n = builder.column("log")[0].as_py(), builder.column("n")[0].as_py()
    above = unpack_path(builder.column("path")[0].as_py())
    digests, shown = leaves.field("leaf").to_pylist(), leaves.field("presented").to_pylist()
    levels = _levels(n, bits)
    upper = "".join(digest.hex() for _, digest in above).encode()
    proofs, folded, sides, siblings = [], [], [], []
    for place, (digest, other) in enumerate(zip(digests, shown)):
        path = list(siblings_in(log, place, len(digests), levels))
        text = "".join(sibling.hex() for _, sibling in path).encode()
        proofs.append(hashlib.sha256(text + upper).hexdigest())
        folded.append(fold(digest if other is None else other, path + above).hex())
        if with_siblings:
            sides.append([side for side, _ in path + above])
            siblings.append([one.hex() for side, one in path + above if side >= 0])
    columns = {
        "key": leaves.field("key"),
        "leaf": pa.array([d.hex() for d in digests]),
        "subroot": pa.array([builder.column("subroot")[0].as_py().hex()] * len(digests)),
        "root": pa.array([root] * len(digests)),
        "proof_sha256": pa.array(proofs),
        "folded_root": pa.array(folded),
        "verified": pa.array([one == root for one in folded]),
    }
    if with_siblings:
        columns["sides"] = pa.array(sides, pa.list_(pa.int32()))
        columns["siblings"] = pa.array(siblings, pa.list_(pa.string()))
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
