"""Exact duplicates by composable polynomial fingerprints.

A text is the number whose digits are its bytes, and its fingerprint that number modulo
four primes, in a fixed base for each. Fingerprints compose: that of ``a || b`` is
``f(a) * base ** len(b) + f(b)``. So a long text is cut into chunks which any tasks hash
in any order; each hash is shifted by the length of what follows it and the sum is the
fingerprint of the whole. Texts of one chunk are hashed where they lie.

Equal length and fingerprint only make texts candidates. Their chunks are then compared
byte by byte: chunks of one hash are streamed through a grouping by their content, which
folds equal ones before the shuffle, so that a group of copies, however large, sends one
chunk per map task. A hash that stands for several contents splits its texts, by the
contents that each of them holds; ids are never compared in place of bytes.

Null texts count as empty, and empty texts are equal to each other. Of equal texts the row
with the greatest id stays; a null id is less than any other, and of rows that share the id
as well exactly one stays. An empty table gives an empty result. Columns other than key and
text do not matter, so their names cannot clash.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import bound_batches, quoted
from martkit.operators.joins import BROADCAST_BYTES, BROADCAST_ROWS, fits_broadcast, lookup_join
from martkit.session import materialize

# Bytes of a chunk. A text beyond it is hashed by several tasks.
CHUNK = 1 << 16

# The greatest primes below 2 ** 31, so that products stay below 2 ** 62.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
BASES = (1181783497, 1903816297, 1500450271, 2038074743)

# Bytes hashed by one product of matrices: byte, weight and 2 ** 10 terms stay below
# 2 ** 49, which doubles hold exactly.
BLOCK = 1 << 10
# Blocks that are turned into doubles at a time.
STRIPE = 2048

PARTS = [f"p{i}" for i in range(len(PRIMES))]


def chunk_hasher(
    primes: tuple[int, ...] = PRIMES, bases: tuple[int, ...] = BASES, chunk: int = CHUNK
):
    """A function from byte strings, of at most ``chunk`` bytes, to their hashes.

    The result is an array with a row for each string and a column for each prime.
    """
    import numpy as np

    weights = np.empty((BLOCK, len(primes)))
    shifts = np.empty((chunk // BLOCK + 1, len(primes)), np.int64)
    for i, (prime, base) in enumerate(zip(primes, bases)):
        weights[:, i] = [pow(base, BLOCK - 1 - j, prime) for j in range(BLOCK)]
        shifts[:, i] = [pow(base, BLOCK * j, prime) for j in range(len(shifts))]
    moduli = np.array(primes, np.int64)

    def hashes(texts: list) -> np.ndarray:
        # each text fills whole blocks from behind: zeros in front do not change it
        blocks = np.array([max(1, -(-len(text) // BLOCK)) for text in texts], np.int64)
        ends = np.cumsum(blocks)
        flat = np.zeros(int(ends[-1]) * BLOCK, np.uint8)
        for text, end in zip(texts, (ends * BLOCK).tolist()):
            if len(text):
                flat[end - len(text) : end] = np.frombuffer(text, np.uint8)
        matrix = flat.reshape(-1, BLOCK)
        found = np.empty((len(matrix), len(primes)), np.int64)
        for at in range(0, len(matrix), STRIPE):
            found[at : at + STRIPE] = matrix[at : at + STRIPE].astype(np.float64) @ weights
        found %= moduli
        after = np.repeat(ends, blocks) - 1 - np.arange(len(matrix))
        found *= shifts[after]
        found %= moduli
        return np.add.reduceat(found, ends - blocks, axis=0) % moduli

    return hashes


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, body, n_bytes): texts as bytes, null ones as none."""
    body = F.coalesce(quoted(text), F.lit("")).cast("binary")
    rows = docs.select(quoted(key).alias("key"), body.alias("body"))
    return rows.withColumn("n_bytes", F.octet_length("body").cast("bigint"))


def _chunks(texts: DataFrame, chunk: int) -> DataFrame:
    """``texts`` with (chunk, body) for each of their chunks; an empty text has one."""
    last = F.greatest(F.expr(f"(n_bytes - 1) div {chunk}"), F.lit(0)).cast("int")
    cut = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.substring("body", i * chunk + 1, F.lit(chunk))
    )
    others = [c for c in texts.columns if c != "body"]
    return texts.select(*others, F.posexplode(cut).alias("chunk", "body"))


def _coded(chunks: DataFrame, chunk: int, primes: tuple, bases: tuple, keep_body: bool) -> DataFrame:
    """Each chunk with its hash (``code``), and shifted by the length of what follows it."""
    bound_batches(chunks.sparkSession)
    kinds = dict(chunks.dtypes)
    fields = [f"`{c}` {kinds[c]}" for c in chunks.columns if keep_body or c != "body"]
    schema = ", ".join([*fields, "code binary", *[f"{p} bigint" for p in PARTS[: len(primes)]]])

    def code(batches):
        import numpy as np

        hashes = chunk_hasher(primes, bases, chunk)
        for batch in batches:
            if not batch.num_rows:
                continue
            bodies = [b.as_buffer() if b.is_valid else b"" for b in batch.column("body")]
            found = hashes(bodies)
            total = batch.column("n_bytes").to_numpy(zero_copy_only=False)
            number = batch.column("chunk").to_numpy(zero_copy_only=False).astype(np.int64)
            after = np.maximum(total - (number + 1) * chunk, 0)
            shifted = found.copy()
            for row in np.flatnonzero(after).tolist():
                for i, (prime, base) in enumerate(zip(primes, bases)):
                    shifted[row, i] = int(found[row, i]) * pow(base, int(after[row]), prime) % prime
            width = 4 * len(primes)
            raw = found.astype("<u4").tobytes()
            codes = pa.array([raw[i : i + width] for i in range(0, len(raw), width)], pa.binary())
            kept = [batch.column(c) for c in batch.schema.names if keep_body or c != "body"]
            names = [c for c in batch.schema.names if keep_body or c != "body"]
            parts = [pa.array(np.ascontiguousarray(shifted[:, i])) for i in range(len(primes))]
            yield pa.RecordBatch.from_arrays(
                [*kept, codes, *parts], names=[*names, "code", *PARTS[: len(primes)]]
            )

    return chunks.mapInArrow(code, schema)


def fingerprint_texts(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    chunk: int = CHUNK,
    primes: tuple[int, ...] = PRIMES,
    bases: tuple[int, ...] = BASES,
) -> DataFrame:
    """One row per row of ``docs``: row, key, n_bytes, sha, p0.., codes.

    ``p0`` and so on are the fingerprint, ``codes`` the hashes of its chunks in order, ``sha``
    the SHA-256 of the text. ``row`` tells rows apart once the result is stored. It follows
    positions in a scan, so ``docs`` should be a scan or narrow steps over one.
    """
    parts = PARTS[: len(primes)]
    rows = _texts(docs, key, text)
    rows = rows.withColumn("sha", F.sha2("body", 256))
    short = rows.where(F.col("n_bytes") <= chunk).withColumn("chunk", F.lit(0))
    short = short.withColumn("row", F.monotonically_increasing_id() * 2)
    columns = ["row", "key", "n_bytes", "sha"]
    whole = _coded(short, chunk, primes, bases, keep_body=False)
    whole = whole.select(*columns, *parts, F.col("code").alias("codes"))

    long = rows.where(F.col("n_bytes") > chunk)
    long = long.withColumn("row", F.monotonically_increasing_id() * 2 + 1)
    # chunks of one long text go to different tasks
    spread = _chunks(long, chunk).repartition("row", "chunk")
    coded = _coded(spread, chunk, primes, bases, keep_body=False)
    in_order = F.array_sort(F.collect_list(F.struct("chunk", "code")))
    composed = coded.groupBy(*columns).agg(
        *[F.sum(p).alias(p) for p in parts],
        F.array_join(F.transform(in_order, lambda c: F.hex(c["code"])), "").alias("codes"),
    )
    composed = composed.select(
        *columns,
        *[(F.col(p) % prime).alias(p) for p, prime in zip(parts, primes)],
        F.unhex("codes").alias("codes"),
    )
    return whole.unionByName(composed)


def exact_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    chunk: int = CHUNK,
    primes: tuple[int, ...] = PRIMES,
    bases: tuple[int, ...] = BASES,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): one row per row of ``docs``.

    ``keep_id`` is the id of the row that stays of those with equal texts; ``kept`` is true
    for that row alone. ``primes`` and ``bases`` may be chosen weaker: the result stays exact.
    """
    parts = PARTS[: len(primes)]
    names = ["n_bytes", *parts]
    rows = materialize(
        fingerprint_texts(docs, key, text, chunk, primes, bases), "exact-fingerprints"
    )
    rows = rows.withColumn("variant", F.lit(""))
    groups = rows.groupBy(*names).agg(
        F.count(F.lit(1)).alias("n"), F.min("codes").alias("low"), F.max("codes").alias("high")
    )
    candidates = materialize(groups.where("n > 1"), "exact-candidates")
    listed = materialize(_listed(candidates, names, chunk, len(primes)), "exact-listed")
    shared = _shared_codes(docs, listed, text, chunk, primes, bases, max_rows, max_bytes)
    shared = materialize(shared, "exact-collisions")
    mixed = candidates.where(F.col("low") != F.col("high")).select(*names)
    if not (shared.isEmpty() and mixed.isEmpty()):
        doubtful = lookup_join(listed, shared, ["length", "code"], "inner").select(*names)
        doubtful = doubtful.union(mixed).distinct()
        rows = _split(docs, rows, doubtful, key, text, chunk, primes, bases)

    by = [*names, "variant"]
    classes = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("group_size"), F.max(F.struct("key", "row")).alias("stays")
    )
    repeated = materialize(classes.where("group_size > 1"), "exact-groups")
    weights = repeated.select(*by, F.col("group_size").alias("__weight"))
    found = lookup_join(
        rows, repeated, by, weights=weights, max_rows=max_rows, max_bytes=max_bytes
    )
    alone = F.col("group_size").isNull()
    return found.select(
        F.col("key").alias("doc_id"),
        F.when(alone, F.col("key")).otherwise(F.col("stays.key")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        (alone | (F.col("stays.row") == F.col("row"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def _listed(candidates: DataFrame, names: list[str], chunk: int, primes: int) -> DataFrame:
    """(names, length, code): chunks of the candidates, by their hashes."""
    width = 4 * primes
    last = (F.octet_length("codes") / width).cast("int") - 1
    codes = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.substring("codes", i * width + 1, F.lit(width))
    )
    listed = candidates.select(*names, F.explode(F.array("low", "high")).alias("codes"))
    listed = listed.select(*names, F.posexplode(codes).alias("chunk", "code"))
    length = F.least(F.col("n_bytes") - F.col("chunk") * chunk, F.lit(chunk)).cast("bigint")
    return listed.select(*names, length.alias("length"), "code").distinct()


def _shared_codes(
    docs: DataFrame,
    listed: DataFrame,
    text: str,
    chunk: int,
    primes: tuple,
    bases: tuple,
    max_rows: int,
    max_bytes: int,
) -> DataFrame:
    """(length, code): hashes of candidates' chunks that stand for more than one content."""
    wanted = materialize(listed.select("length", "code").distinct(), "exact-wanted")
    chunks = _chunks(_texts(docs, text, text).drop("key"), chunk)
    coded = _coded(chunks, chunk, primes, bases, keep_body=True)
    coded = coded.select(F.octet_length("body").cast("bigint").alias("length"), "code", "body")
    # beyond the bounds all chunks are grouped, which gives the same for candidates
    if fits_broadcast(wanted, max_rows, max_bytes):
        coded = coded.join(F.broadcast(wanted), ["length", "code"], "left_semi")
    contents = coded.groupBy("length", "code", "body").agg(F.count(F.lit(1)).alias("n"))
    return _ambiguous(contents)


def _ambiguous(contents: DataFrame) -> DataFrame:
    several = contents.groupBy("length", "code").agg(F.count(F.lit(1)).alias("contents"))
    return several.where("contents > 1").drop("contents")


def _split(
    docs: DataFrame,
    rows: DataFrame,
    doubtful: DataFrame,
    key: str,
    text: str,
    chunk: int,
    primes: tuple,
    bases: tuple,
) -> DataFrame:
    """``rows``, with a ``variant`` for those whose fingerprint may stand for several texts.

    Runs only after a collision was found, over the texts of ``doubtful`` fingerprints. The
    variant lists hash and number of content of each chunk, so two texts of equal
    fingerprint have equal variants only if all their chunks are equal byte by byte.
    """
    parts = PARTS[: len(primes)]
    columns = ["row", "key", "n_bytes", "sha"]
    texts = _texts(docs, key, text).withColumn("sha", F.sha2("body", 256))
    texts = texts.withColumn("row", F.monotonically_increasing_id())
    again = materialize(
        lookup_join(rows, doubtful, ["n_bytes", *parts], "inner").select("sha").distinct(),
        "exact-doubtful",
    )
    coded = _chunks(lookup_join(texts, again, ["sha"], "inner"), chunk)
    coded = _coded(coded, chunk, primes, bases, keep_body=True)
    coded = materialize(
        coded.withColumn("length", F.octet_length("body").cast("bigint")), "exact-split"
    )
    contents = materialize(coded.select("length", "code", "body").distinct(), "exact-contents")
    several = lookup_join(contents, _ambiguous(contents), ["length", "code"], "inner")
    # numbers are given once, in a stored table
    numbered = materialize(
        several.withColumn("content", F.monotonically_increasing_id()), "exact-numbers"
    )
    found = lookup_join(coded, numbered, ["length", "code", "body"])
    token = F.concat_ws(":", F.hex("code"), F.col("content").cast("string"))
    whole = found.groupBy(*columns).agg(
        *[F.sum(p).alias(p) for p in parts],
        F.array_sort(F.collect_list(F.struct("chunk", token.alias("token")))).alias("chunks"),
    )
    whole = whole.select(
        *columns,
        *[(F.col(p) % prime).alias(p) for p, prime in zip(parts, primes)],
        F.lit(None).cast("binary").alias("codes"),
        F.array_join(F.transform("chunks", lambda c: c["token"]), ",").alias("variant"),
    )
    rest = lookup_join(rows, again, ["sha"], "left_anti")
    return rest.unionByName(materialize(whole, "exact-variants"))
