"""Ranked lexical search by bit-sliced Bloom signatures, with exact scores.

The index keeps no postings. Documents of similar size form blocks, and a block stores,
for every position of their Bloom signatures, one bitmap of its documents (a slice). A term
is present at most where all its slices have a bit. Frequencies are filed too: a term that
occurs ``t`` times is entered once for each of the steps 1, 2, 3, 4, 6, 8, 12 and so on up to
``t``, so the bitmaps of a step overestimate where the frequency is at least that. What a
step adds to the score at most is known for each document from its length; summed over
terms and steps, the weighted slices bound a document's score from above.

Search takes two rounds. The documents with the highest bounds are scored exactly, which
gives a score that k documents reach; then every document whose bound reaches it is scored
exactly, and only those are left out that provably cannot be among the k best. False
positives of the signatures thus cost time but never change a result.

Terms are runs of ASCII letters, ASCII digits and non-ASCII characters, with A-Z in lower
case. Weights and scores are integers; see :func:`term_weight` and :func:`term_score`.

Null texts and texts without terms are in no result and do not count as documents. Items
without terms have no result. Of equal scores, the lesser id comes first, a null id before
all others; rows that share id and text are ranked one after the other. Items that are
repeated, id and text, count once; one id with two texts is ranked for each. Empty tables
give an empty result. Only the named columns are read, so no other names can clash.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from martkit.llm.common import bound_batches, quoted
from martkit.operators.joins import lookup_join
from martkit.session import materialize

# Slices that a term is looked up in, and signature bits per entry (at least).
HASHES = 6
BITS = 12

# Documents tried first for each of the k that are asked for: some of those with the
# highest bounds are there by false positives alone, and would give a low score to reach.
TRIED = 4

# A block holds so many bits, and documents between these bounds.
BLOCK_BITS = 1 << 22
BLOCK_ROWS = (8, 2048)
# Widths of signatures. Beyond the greatest, entries crowd, so bounds get loose and the
# document is more often scored exactly.
LEAST_WIDTH, MOST_WIDTH = 128, 1 << 20

# Different terms that a task counts before it passes the counts on.
COUNTED = 100_000

# Items are searched for in lots of so many items or terms; an item is never split.
LOT_ITEMS, LOT_TERMS = 1024, 131_072

# Bitmaps that are spread out to numbers at a time, in elements.
SPREAD = 1 << 22

# A step of frequencies beyond any text.
ENDLESS = 1 << 40
STEPS = [1, 2, 3] + [s for i in range(2, 31) for s in (1 << i, 3 << (i - 1))] + [ENDLESS]

INDEX = (
    "kind int, term binary, number bigint, terms bigint, "
    "width int, lengths binary, texts binary, slices binary"
)
BLOCK, TERM, TOTAL = 0, 1, 2

_LETTERS = bytes(
    b + 32
    if 65 <= b <= 90
    else b
    if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122
    else 32
    for b in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a text in UTF-8, in order and with repeats."""
    return text.translate(_LETTERS).split()


def term_weight(documents: int, holding: int) -> int:
    """Weight of a term that ``holding`` of ``documents`` documents contain."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def length_norm(length, documents: int, terms: int):
    """The norm of a document of ``length`` terms, out of ``documents`` with ``terms`` in all."""
    return 50 + (50 * length * documents) // max(terms, 1)


def term_score(frequency, norm):
    """What a term of weight 1 adds; grows with the frequency, below a million."""
    return (1_000_000_000 * frequency) // (1000 * frequency + 20 * norm)


# -- signatures ---------------------------------------------------------------


def entry_keys(codes, step):
    """64-bit keys of entries: a term's checksum and the number of the frequency step."""
    import numpy as np

    x = (codes.astype(np.uint64) << np.uint64(8)) | np.uint64(step)
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slice_numbers(keys, width: int):
    """The slices of each key, (HASHES, keys); ``width`` is a power of two."""
    import numpy as np

    first, stride = keys & np.uint64(0xFFFFFFFF), (keys >> np.uint64(32)) | np.uint64(1)
    turns = np.arange(HASHES, dtype=np.uint64)[:, None]
    return ((first + turns * stride) & np.uint64(width - 1)).astype(np.int64)


def signature_width(entries: int) -> int:
    return min(MOST_WIDTH, max(LEAST_WIDTH, 1 << (BITS * entries - 1).bit_length()))


def block_rows(width: int) -> int:
    low, high = BLOCK_ROWS
    return min(high, max(low, BLOCK_BITS // width))


def _keys_of(counts: Counter):
    """Keys of all entries of a document."""
    import numpy as np

    codes = np.fromiter(map(crc32, counts), np.uint64, len(counts))
    often = np.fromiter(counts.values(), np.int64, len(counts))
    keys = [entry_keys(codes, 0)]
    for number, step in enumerate(STEPS[1:], 1):
        reach = often >= step
        if not reach.any():
            break
        codes, often = codes[reach], often[reach]
        keys.append(entry_keys(codes, number))
    return np.concatenate(keys)


def _slices(keys: list, width: int) -> bytes:
    """The bitmaps of a block, one after the other; documents fill whole bytes."""
    import numpy as np

    rows = -(-len(keys) // 8) * 8
    matrix = np.zeros((width, rows), bool)
    of_row = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    for numbers in slice_numbers(np.concatenate(keys), width):
        matrix[numbers, of_row] = True
    return np.packbits(matrix, axis=1).tobytes()


def _records(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.binary(), *[pa.int64()] * 2, pa.int32(), *[pa.binary()] * 3)
    names = [field.split()[0] for field in INDEX.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names=names
    )


def _index_task(batches):
    """Blocks, document frequencies and totals of the documents of one task."""
    import numpy as np

    open_blocks: dict[int, list] = {}
    holding: Counter = Counter()
    documents = terms = 0

    def block(width: int) -> pa.RecordBatch:
        keys, lengths, texts = zip(*open_blocks.pop(width))
        packed = [np.array(column, np.int64).tobytes() for column in (lengths, texts)]
        return _records([(BLOCK, None, len(keys), None, width, *packed, _slices(keys, width))])

    def counted() -> pa.RecordBatch:
        rows = [(TERM, term, n, *[None] * 5) for term, n in holding.items()]
        holding.clear()
        return _records(rows)

    for batch in batches:
        for body, text in zip(batch.column("body"), batch.column("text").to_pylist()):
            counts = Counter(terms_of(body.as_py()))
            if not counts:
                continue
            length = counts.total()
            documents, terms = documents + 1, terms + length
            holding.update(counts.keys())
            keys = _keys_of(counts)
            width = signature_width(len(keys))
            rows = open_blocks.setdefault(width, [])
            rows.append((keys, length, text))
            if len(rows) == block_rows(width):
                yield block(width)
            if len(holding) >= COUNTED:
                yield counted()
    for width in list(open_blocks):
        yield block(width)
    if holding:
        yield counted()
    if documents:
        yield _records([(TOTAL, None, documents, terms, *[None] * 4)])


@dataclass(frozen=True)
class SignatureIndex:
    """The stored index of documents; ``documents`` have at least one of ``terms`` terms."""

    entries: DataFrame
    documents: int
    terms: int


def _bodies(docs: DataFrame, text: str) -> DataFrame:
    """(body, text): texts in UTF-8, and the hash by which searches come back to them."""
    body = F.coalesce(quoted(text), F.lit(""))
    return docs.select(body.cast("binary").alias("body"), F.xxhash64(body).alias("text"))


def build_index(docs: DataFrame, text: str = "text") -> SignatureIndex:
    """Read every document once and store signatures, document frequencies and totals."""
    bound_batches(docs.sparkSession)
    entries = materialize(_bodies(docs, text).mapInArrow(_index_task, INDEX), "lexical-index")
    totals = entries.where(F.col("kind") == TOTAL).agg(F.sum("number"), F.sum("terms")).first()
    return SignatureIndex(entries, totals[0] or 0, totals[1] or 0)


# -- search -------------------------------------------------------------------


@dataclass(frozen=True)
class _Lot:
    """Some items: numbers, their ids, and the weights of their terms."""

    numbers: list[int]
    weights: list[dict[bytes, int]]


def _lots(spark: SparkSession, queries: DataFrame) -> Iterator[list[tuple[int, list[bytes]]]]:
    """The items with their different terms, lot by lot; the driver holds one lot at a time."""
    lot, held = [], 0
    for row in queries.select("number", "terms").toLocalIterator():
        if lot and (len(lot) >= LOT_ITEMS or held + len(row["terms"]) > LOT_TERMS):
            yield lot
            lot, held = [], 0
        lot.append((row["number"], [bytes(t) for t in row["terms"]]))
        held += len(row["terms"])
    if lot:
        yield lot


def _query_terms(queries: DataFrame, item: str, text: str) -> DataFrame:
    """(number, item, terms): the items that differ, with their different terms."""
    spark = queries.sparkSession
    rows = queries.select(quoted(item).alias("item"), F.coalesce(quoted(text), F.lit("")).alias("text"))
    kind = dict(rows.dtypes)["item"]

    def split(batches):
        for batch in batches:
            found = [sorted(set(terms_of(t.encode()))) for t in batch.column("text").to_pylist()]
            terms = pa.array(found, pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("item"), terms], names=["item", "terms"]
            )

    bound_batches(spark)
    terms = rows.distinct().mapInArrow(split, f"item {kind}, terms array<binary>")
    terms = terms.where(F.size("terms") > 0)
    return materialize(terms.withColumn("number", F.monotonically_increasing_id()), "lexical-items")


def _weighted(index: SignatureIndex, lot: list[tuple[int, list[bytes]]]) -> _Lot:
    """The lot with weights; terms that no document holds are left out."""
    spark = index.entries.sparkSession
    asked = sorted({term for _, terms in lot for term in terms})
    # at most LOT_TERMS terms, or those of one item
    vocabulary = spark.createDataFrame([(term,) for term in asked], "term binary")
    known = index.entries.where(F.col("kind") == TERM).select("term", "number")
    held = lookup_join(known, vocabulary, ["term"], "inner").groupBy("term").agg(F.sum("number"))
    weights = {bytes(t): term_weight(index.documents, n) for t, n in held.collect()}
    # a term that nearly all documents hold may weigh nothing
    kept = [{t: weights[t] for t in terms if weights.get(t)} for _, terms in lot]
    return _Lot([number for number, _ in lot], kept)


class _Bounder:
    """Upper bounds of the scores of a block's documents, for the items of a lot."""

    def __init__(self, lot: _Lot, documents: int, terms: int):
        import numpy as np

        self.documents, self.terms = documents, terms
        vocabulary = sorted({term for weights in lot.weights for term in weights})
        at = {term: i for i, term in enumerate(vocabulary)}
        self.codes = np.array([crc32(term) for term in vocabulary], np.uint64)
        self.items = []
        for weights in lot.weights:
            places = np.array(sorted(at[t] for t in weights), np.int64)
            values = np.array([weights[vocabulary[p]] for p in places], np.float64)
            self.items.append((places, values))

    def bounds(self, width: int, lengths, slices: bytes):
        """(items, documents) of the block, as integers."""
        import numpy as np

        bitmaps = np.frombuffer(slices, np.uint8).reshape(width, -1)
        rows = bitmaps.shape[1] * 8
        norm = length_norm(lengths, self.documents, self.terms)
        total = np.zeros((len(self.items), len(lengths)), np.int64)
        lot = max(64, SPREAD // rows)
        for begin in range(0, len(self.codes), lot):
            active = np.arange(begin, min(begin + lot, len(self.codes)))
            present, reached = None, np.int64(0)
            for number, step in enumerate(STEPS[:-1]):
                slots = slice_numbers(entry_keys(self.codes[active], number), width)
                found = bitmaps[slots[0]]
                for turn in slots[1:]:
                    found &= bitmaps[turn]
                if present is not None:
                    found &= present
                some = found.any(axis=1)
                active, present = active[some], found[some]
                if not len(active):
                    break
                # the most that a frequency between this step and the next adds
                most = np.minimum(STEPS[number + 1] - 1, np.maximum(lengths, step))
                best = term_score(most, norm)
                self._add(total, active, present, best - reached)
                reached = best
        return total

    def _add(self, total, active, present, gain) -> None:
        import numpy as np

        spread = np.unpackbits(present, axis=1, count=total.shape[1]).astype(np.float64)
        for item, (places, values) in enumerate(self.items):
            at = np.searchsorted(active, places)
            at[at == len(active)] = 0
            hit = active[at] == places
            if hit.any():
                summed = values[hit] @ spread[at[hit]]
                total[item] += summed.astype(np.int64) * gain


def _bounded(index: SignatureIndex, lot: _Lot, k: int, least: dict[int, int] | None) -> DataFrame:
    """(number, bound, text): each task's k best bounds of an item, or all that reach ``least``."""
    documents, terms = index.documents, index.terms
    blocks = index.entries.where(F.col("kind") == BLOCK).select("width", "lengths", "texts", "slices")

    def records(item: int, bounds, texts) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([lot.numbers[item]] * len(texts), pa.int64()), pa.array(bounds), pa.array(texts)],
            names=["number", "bound", "text"],
        )

    def bound(batches):
        import numpy as np

        bounder = _Bounder(lot, documents, terms)
        best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in lot.numbers]
        for batch in batches:
            for row in batch.to_pylist():
                lengths, texts = (np.frombuffer(row[c], np.int64) for c in ("lengths", "texts"))
                found = bounder.bounds(row["width"], lengths, row["slices"])
                for item, bounds in enumerate(found):
                    if least is not None:
                        reach = np.flatnonzero(bounds >= least[lot.numbers[item]])
                        if len(reach):
                            yield records(item, bounds[reach], texts[reach])
                        continue
                    held, of = best[item]
                    if len(held) == k and bounds.max() <= held.min():
                        continue
                    held, of = np.concatenate([held, bounds]), np.concatenate([of, texts])
                    first = np.argsort(-held, kind="stable")[:k]
                    best[item] = held[first], of[first]
        for item, (bounds, texts) in enumerate(best):
            some = bounds > 0
            if some.any():
                yield records(item, bounds[some], texts[some])

    bound_batches(index.entries.sparkSession)
    return blocks.mapInArrow(bound, "number bigint, bound bigint, text bigint")


def _scored(
    docs: DataFrame,
    candidates: DataFrame,
    index: SignatureIndex,
    lot: _Lot,
    k: int,
    key: str,
    text: str,
) -> DataFrame:
    """(number, key, score): exact scores above 0 of the candidates, the k best of each task.

    ``candidates``: (number, text). Documents come back by the hash of their text; one that
    comes by chance is scored as well as any other.
    """
    documents, terms = index.documents, index.terms
    wanted = candidates.groupBy("text").agg(F.collect_set("number").alias("numbers"))
    wanted = materialize(wanted, "lexical-candidates")
    body = F.coalesce(quoted(text), F.lit(""))
    rows = docs.select(quoted(key).alias("key"), body.alias("body"), F.xxhash64(body).alias("text"))
    found = lookup_join(rows, wanted, ["text"], "inner").select("key", "body", "numbers")
    kind = dict(found.dtypes)["key"]

    def score(batches):
        weights = dict(zip(lot.numbers, lot.weights))
        best: dict[int, list[tuple]] = {}

        def cut(held: list[tuple]) -> None:
            held.sort()
            del held[k:]

        for batch in batches:
            columns = [batch.column(c) for c in ("key", "body", "numbers")]
            for doc, body, numbers in zip(columns[0].to_pylist(), columns[1], columns[2]):
                counts = Counter(terms_of(body.as_buffer().to_pybytes()))
                norm = length_norm(counts.total(), documents, terms)
                for number in numbers.as_py():
                    own = weights[number]
                    value = sum(
                        own[t] * term_score(counts[t], norm) for t in own.keys() & counts.keys()
                    )
                    if value > 0:
                        held = best.setdefault(number, [])
                        held.append((-value, doc is not None, doc))
                        if len(held) >= 8 * k:
                            cut(held)
        for number, held in best.items():
            cut(held)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number] * len(held), pa.int64()),
                    pa.array([doc for _, _, doc in held], of_key),
                    pa.array([-value for value, _, _ in held], pa.int64()),
                ],
                names=["number", "key", "score"],
            )

    of_key = to_arrow_type(found.schema["key"].dataType)
    bound_batches(docs.sparkSession)
    return found.mapInArrow(score, f"number bigint, key {kind}, score bigint")


def _ranked(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_first("key"))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_lot(
    index: SignatureIndex, docs: DataFrame, lot: _Lot, k: int, key: str, text: str
) -> DataFrame:
    bounds = _bounded(index, lot, TRIED * k, None)
    order = Window.partitionBy("number").orderBy(F.desc("bound"), "text")
    bounds = bounds.withColumn("place", F.row_number().over(order))
    first = bounds.where(F.col("place") <= TRIED * k).select("number", "text")
    probe = materialize(first, "lexical-probe")
    tried = _ranked(_scored(docs, probe.distinct(), index, lot, k, key, text), k)
    reached = tried.groupBy("number").agg(
        F.count(F.lit(1)).alias("n"), F.min("score").alias("score")
    )
    # one row per item of the lot
    scores = {row["number"]: row["score"] for row in reached.where(F.col("n") == k).collect()}
    least = {number: max(1, scores.get(number, 1)) for number in lot.numbers}
    reach = _bounded(index, lot, k, least).select("number", "text")
    return _ranked(_scored(docs, reach, index, lot, k, key, text), k)


def search(
    index: SignatureIndex,
    docs: DataFrame,
    queries: DataFrame,
    k: int = 50,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    query_text: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item, with exact scores.

    ``docs`` are the documents that ``index`` was built of.
    """
    items = _query_terms(queries, item, query_text)
    kinds = dict(docs.select(quoted(key).alias("key")).dtypes)
    spark = docs.sparkSession
    whole = spark.createDataFrame([], f"number bigint, key {kinds['key']}, score bigint, rank int")
    if index.documents:
        for lot in _lots(spark, items):
            found = _search_lot(index, docs, _weighted(index, lot), k, key, text)
            whole = whole.unionByName(materialize(found, "lexical-found"))
    # results are at most k a number, and the items a lookup that is measured
    named = lookup_join(whole, items.select("number", "item"), ["number"], "inner")
    return named.select(
        F.col("item").alias("item_id"),
        F.col("rank").cast("int"),
        F.col("key").alias("doc_id"),
        "score",
    )
