"""Document fingerprints: SimHash of weighted terms, and search by permuted tables.

Terms are the words of a text and its shingles of five words, both in lower case; a
term that occurs n times weighs 1 + ln(n), a shingle SHINGLE_WEIGHT times that. Every
term's hash votes on every bit, for or against it. Equal texts have equal fingerprints.

Texts without a word (empty or null ones too) have the fingerprint of zero bits.
Fingerprints are hex strings of BITS / 4 digits. They are searched by ``hamming``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import bound_batches, once, quoted
from martkit.llm.hamming import BITS, count_near
from martkit.operators.joins import lookup_join
from martkit.session import materialize

SHINGLE = 5
SHINGLE_WEIGHT = 2.0
# Words whose hashes a worker remembers.
REMEMBERED = 400_000
# Terms that vote at once.
LOT = 1 << 14
# Documents whose neighbours are found together by one task, on average, and the most
# ranges there are; the list of their bounds is all that the driver holds.
RANGE_ROWS = 2_000
MOST_RANGES = 20_000
# Bits in which fingerprints of near copies differ at most: texts of which 0.8 of the
# five-word shingles are shared measured 13 to 20, others that share few above 40.
RADIUS = 20
# Documents whose ids this divides are looked up among all.
ASKED = 50


def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits look independent."""
    x = x + np.uint64(0x9E3779B97F4A7C15 * (2 * salt + 1) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes:
    def __init__(self) -> None:
        self.seen: dict[str, int] = {}

    def __call__(self, words: list[str]) -> np.ndarray:
        from xxhash import xxh3_64_intdigest

        seen = self.seen
        missing = [w for w in set(words) if w not in seen]
        if missing:
            if len(seen) > REMEMBERED:
                seen.clear()
                missing = list(set(words))
            seen.update((w, xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))) for w in missing)
        return np.fromiter([seen[w] for w in words], dtype=np.uint64, count=len(words))


def shingles(words: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """One hash for each run of ``width`` words."""
    runs = len(words) - width + 1
    if runs < 1:
        return words[:0]
    total = np.zeros(runs, dtype=np.uint64)
    for i in range(width):
        total = mixed(total + words[i : i + runs], i + 2)
    return total


def fingerprint(text: str, hashes: WordHashes) -> bytes:
    words = hashes(text.lower().split())
    if not len(words):
        return bytes(BITS // 8)
    votes, weight = np.zeros(BITS, dtype=np.float64), 0.0
    for terms, factor in ((words, 1.0), (shingles(words), SHINGLE_WEIGHT)):
        terms, times = np.unique(terms, return_counts=True)
        weights = (factor * (1.0 + np.log(times))).astype(np.float32)
        for at in range(0, len(terms), LOT):
            lot = terms[at : at + LOT]
            lanes = np.stack([mixed(lot, 11 + lane) for lane in range(BITS // 64)], axis=1)
            bits = np.unpackbits(lanes.view(np.uint8), axis=1)
            votes += weights[at : at + LOT] @ bits.astype(np.float32)
        weight += float(weights.sum())
    return np.packbits(votes * 2 > weight).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """The share of equal bits."""
    apart = (int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_count()
    return 1.0 - apart / BITS


def fingerprint_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every document."""
    bound_batches(docs.sparkSession)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = once("word-hashes", WordHashes)
        for batch in batches:
            marks = [fingerprint(t.as_py() or "", hashes).hex() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(marks, pa.string())], names=["doc_id", "fingerprint"]
            )

    rows = docs.select(quoted(key).cast("bigint").alias("doc_id"), quoted(text).alias("text"))
    return rows.mapInArrow(mark, "doc_id bigint, fingerprint string")


EDITED = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document against its edited text and against the next document.

    The next document is the one that follows by descending id, the first after the
    last; equal ids follow one another by the hash of the text. Null ids come last. The
    edited text has its last third replaced by the start of the next document.

    Texts are moved once: rows are dealt out by ranges of ids, and the first row of a
    range goes to the range before it as well.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    least = -(1 << 63)
    rows = docs.select(quoted(key).cast("bigint").alias("doc_id"), quoted(text).alias("text"))
    rows = rows.withColumns(
        {
            "rank": F.coalesce("doc_id", F.lit(least)),
            "tie": F.xxhash64(F.coalesce("text", F.lit(""))),
        }
    )
    keys = materialize(rows.select("rank", "tie"), "ranks")
    total = keys.count()
    ranges = min(MOST_RANGES, max(1, total // RANGE_ROWS))
    kept = min(1.0, 64 * ranges / max(total, 1))
    share = F.pmod(F.xxhash64("rank", "tie", F.lit(7)), F.lit(1 << 30)) < int(kept * (1 << 30))
    seen = sorted((r["rank"], r["tie"]) for r in keys.where(share).collect())
    bounds = sorted({seen[len(seen) * i // ranges] for i in range(1, ranges)}) if seen else []
    ranks = np.array([b[0] for b in bounds], dtype=np.int64)
    ties = np.array([b[1] for b in bounds], dtype=np.int64)

    def range_of(rank: np.ndarray, tie: np.ndarray) -> np.ndarray:
        """How many bounds are at or below (rank, tie)."""
        low = np.searchsorted(ranks, rank, "left")
        high = np.searchsorted(ranks, rank, "right")
        return np.array(
            [a + np.searchsorted(ties[a:b], t, "right") for a, b, t in zip(low, high, tie)],
            dtype=np.int32,
        )

    @F.arrow_udf("int")
    def find_range(rank: pa.Array, tie: pa.Array) -> pa.Array:
        return pa.array(range_of(rank.to_numpy(), tie.to_numpy()), pa.int32())

    tops = keys.withColumn("part", find_range("rank", "tie")).groupBy("part")
    tops = tops.agg(F.max(F.struct("rank", "tie")).alias("top")).orderBy("part").collect()
    # the highest row of a part follows the lowest row of the part above
    follows: dict[tuple[int, int], list[int]] = {}
    for here, above in zip(tops, tops[1:] + tops[:1]):
        follows.setdefault((here["top"]["rank"], here["top"]["tie"]), []).append(above["part"])

    @F.arrow_udf("array<int>")
    def find_parts(rank: pa.Array, tie: pa.Array) -> pa.Array:
        rank, tie = rank.to_numpy(), tie.to_numpy()
        own = range_of(rank, tie).tolist()
        # a part above is noted as -1 - part
        return pa.array(
            [
                [part, *(-1 - p for p in follows.get(pair, ()))]
                for part, pair in zip(own, zip(rank.tolist(), tie.tolist()))
            ],
            pa.list_(pa.int32()),
        )

    part = F.when(F.col("to") < 0, -1 - F.col("to")).otherwise(F.col("to"))
    dealt = rows.withColumn("to", F.explode(find_parts("rank", "tie")))
    dealt = dealt.withColumns({"part": part, "follows": F.col("to") < 0})
    dealt = dealt.select("part", "follows", "rank", "tie", "doc_id", "text")
    dealt = dealt.repartition("part").sortWithinPartitions(
        "part", "follows", F.desc("rank"), F.desc("tie")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = once("word-hashes", WordHashes)
        last = None
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for part, follows, doc, body in zip(*(batch.column(i) for i in (0, 1, 4, 5))):
                body = body.as_py() or ""
                now = (part.as_py(), follows.as_py(), doc.as_py(), body, fingerprint(body, hashes))
                # of equal highest rows the copies that follow after the first add nothing
                if last and not last[1] and last[0] == now[0]:
                    n = len(last[3])
                    third = n // 3
                    edited = last[3][: n - third] + body[:third]
                    mark = last[4] if edited == last[3] else fingerprint(edited, hashes)
                    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                    near = (likeness(last[4], mark), likeness(last[4], now[4]))
                    row = (last[2], n, digest, last[4].hex(), mark.hex(), *near)
                    for column, value in zip(out, row):
                        column.append(value)
                last = now
            types = [pa.int64()] * 2 + [pa.string()] * 3 + [pa.float64()] * 2
            names = [f.split()[0] for f in EDITED.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, types)], names=names
            )

    return dealt.mapInArrow(compare, EDITED)


def add_near(marks: DataFrame, radius: int = RADIUS, every: int = ASKED) -> DataFrame:
    """``marks`` with n_near and nearest_bits, for the rows whose ``doc_id`` ``every`` divides.

    ``n_near`` counts the other rows of ``marks`` whose fingerprint differs in at most
    ``radius`` bits, ``nearest_bits`` is the least difference, null where there are none.
    Other rows (also those without an id) have null for both. ``marks`` is read
    several times and should be stored.
    """
    chosen = F.coalesce(F.col("doc_id") % every == 0, F.lit(False))
    asked = marks.where(chosen)
    queries = asked.select("fingerprint").distinct()
    others = count_near(queries, marks, radius)
    # copies with the very same fingerprint
    equal = lookup_join(marks.select("fingerprint"), materialize(queries, "asked"), ["fingerprint"], "inner")
    equal = equal.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("same"))
    found = equal.join(others, "fingerprint", "left")
    found = materialize(found, "near-counts")
    rows = lookup_join(asked, found, ["fingerprint"], "left").select(
        *marks.columns,
        (F.coalesce("n_near", F.lit(0)) + F.col("same") - 1).alias("n_near"),
        F.when(F.col("same") > 1, 0).otherwise(F.col("nearest")).alias("nearest_bits"),
    )
    rest = marks.where(~chosen).select(
        "*",
        F.lit(None).cast("bigint").alias("n_near"),
        F.lit(None).cast("int").alias("nearest_bits"),
    )
    return rows.unionByName(rest)
