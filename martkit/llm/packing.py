"""Best-fit packing by minimum bin slack.

Documents become token pieces of at most ``capacity`` ids. Which lengths share a
sequence is decided on the histogram of lengths, which has at most ``capacity``
entries however many documents there are: the longest piece left opens a sequence, a
subset-sum over the lengths that remain (a bitset, one bit per reachable sum) finds
the fullest filling of the rest, and that combination is taken off the histogram as
many times as it fits. Spark then numbers the pieces of each length and looks up the
sequence and the offset of each number.

Null texts are empty; an empty document is the end token alone. Rows with equal ids
are packed each on its own. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martkit.llm.common import bound_batches, once, quoted
from martkit.session import materialize

CAPACITY = 2048
END_ID = 0
# Spread of the pieces of one length over tasks, for lengths that many share.
SPREAD = 1024
# Bytes that one generation of remembered words, or parts of words, may take. A worker
# holds two generations of each, and an entry takes so much besides its letters and ids.
GENERATION = 64 << 20
ENTRY = 180
# Characters of text that are looked up together.
LOT = 1 << 20
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"

# Characters that Python splits at but that are no white space to the tokenizer.
SEPARATORS = "\x1c\x1d\x1e\x1f"


# Words that the tokenizer cuts into runs of letters, single digits and runs of other
# signs: lower case and composed forms of these characters are what Python makes of them.
SIMPLE = re.compile(r"[\x21-\x26\x28-\x7eÀ-ÖØ-öø-ÿ]+")
PARTS = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
SPECIAL = "<|"


class Memory:
    """Two generations of remembered ids; what is asked for again moves to the younger."""

    def __init__(self) -> None:
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def add(self, found: dict[str, bytes]) -> None:
        self.young.update(found)
        self.held += ENTRY * len(found) + sum(map(len, found)) + sum(map(len, found.values()))

    def missing(self, wanted: set[str]) -> set[str]:
        """Those of ``wanted`` that are not known; all others are in the younger now."""
        if self.held > GENERATION:
            self.old, self.young, self.held = self.young, {}, 0
        wanted = wanted - self.young.keys()
        known = wanted & self.old.keys()
        self.add({w: self.old[w] for w in known})
        return wanted - known


class WordIds:
    """Token ids of texts as little-endian unsigned 32-bit numbers.

    The tokenizer never joins what white space parts, so ids are looked up word by
    word. A new word is looked up by its parts, and new parts go through the tokenizer
    together: each of them ends with a token that ends a word, and only there.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        size = self.tokenizer.get_vocab_size()
        self.ends = np.zeros(size, dtype=bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.ends[number] = bool(suffix) and token.endswith(suffix)
        self.by_parts = bool(suffix)
        self.words, self.parts = Memory(), Memory()

    def encode(self, texts: list[str]) -> list[bytes]:
        batch = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in batch]

    def learn_parts(self, parts: list[str]) -> None:
        for at in range(0, len(parts), 2_000):
            some = parts[at : at + 2_000]
            ids = np.frombuffer(self.encode([" ".join(some)])[0], dtype="<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(some) and cuts[-1] == len(ids):
                found = [x.tobytes() for x in np.split(ids, cuts[:-1])]
            else:
                found = self.encode(some)
            self.parts.add(dict(zip(some, found)))

    def learn(self, words: set[str]) -> None:
        simple, other = {}, []
        for word in words:
            if self.by_parts and SIMPLE.fullmatch(word) and SPECIAL not in word:
                simple[word] = PARTS.findall(word.lower())
            else:
                other.append(word)
        self.learn_parts(sorted(self.parts.missing({p for ps in simple.values() for p in ps})))
        known = self.parts.young
        self.words.add({w: b"".join([known[p] for p in parts]) for w, parts in simple.items()})
        self.words.add(dict(zip(other, self.encode(other))))

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. Texts should be a batch of bounded size."""
        odd = [any(c in t for c in SEPARATORS) for t in texts]
        words = [[] if o else t.split() for t, o in zip(texts, odd)]
        self.learn(self.words.missing(set().union(*words)))
        ids = self.words.young
        return [
            self.encode([t])[0] if o else b"".join([ids[w] for w in ws])
            for t, o, ws in zip(texts, odd, words)
        ]


def encode_lots(encode: WordIds, texts: pa.Array) -> Iterator[bytes]:
    """The ids of all texts, made in lots so that little is held at once."""
    lot, size = [], 0
    for text in texts:
        lot.append(text.as_py() or "")
        size += len(lot[-1])
        if size > LOT:
            yield from encode(lot)
            lot, size = [], 0
    yield from encode(lot)


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit numbers.
    """
    bound_batches(docs.sparkSession)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * with_ids
    schema = pa.schema(list(zip(names, types)))
    width = 4 * capacity
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = once(f"word-ids {tokenizer}", lambda: WordIds(tokenizer))
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for doc, ids in zip(batch.column(0).to_pylist(), encode_lots(encode, batch.column(1))):
                ids += end
                for piece, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    row = (doc, piece, at // 4, len(part) // 4, zlib.crc32(part), part)
                    for column, value in zip(out, row):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, types)], schema=schema
            )

    rows = docs.select(quoted(key).cast("bigint").alias("doc_id"), quoted(text).alias("text"))
    return rows.mapInArrow(cut, PIECES + ", ids binary" * with_ids)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The lengths (and how many of each) whose sum comes closest to ``room``."""
    reach, steps = 1, []
    full, limit = 1 << room, (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, lot = min(counts[length], room // length), 1
        while left > 0 and not reach & full:
            lot = min(lot, left)
            steps.append((length, lot, reach))
            reach |= (reach << (length * lot)) & limit
            left, lot = left - lot, lot * 2
        if reach & full:
            break
    total, taken = reach.bit_length() - 1, {}
    for length, lot, before in reversed(steps):
        if not before >> total & 1:
            total -= length * lot
            taken[length] = taken.get(length, 0) + lot
    return taken


def bin_patterns(
    histogram: dict[int, int], capacity: int = CAPACITY
) -> list[tuple[dict[int, int], int]]:
    """(lengths and how many of each, number of sequences filled so) until none is left."""
    counts = {length: n for length, n in histogram.items() if n > 0}
    patterns = []
    while counts:
        longest = max(counts)
        rest = dict(counts)
        rest[longest] -= 1
        pattern = fullest({x: n for x, n in rest.items() if n}, capacity - longest)
        pattern[longest] = pattern.get(longest, 0) + 1
        times = min(counts[x] // k for x, k in pattern.items())
        patterns.append((pattern, times))
        for x, k in pattern.items():
            counts[x] -= k * times
            if not counts[x]:
                del counts[x]
    return patterns


def _slots(patterns: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """For each length, which of its numbers go where; sorted by (length, first number)."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for length in sorted(pattern, reverse=True):
            k = pattern[length]
            rows.append((length, used.get(length, 0), k, sequence, offset))
            used[length] = used.get(length, 0) + k * times
            offset += k * length
        sequence += times
    rows.sort()
    columns = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return dict(zip(("length", "first", "each", "sequence", "offset"), columns))


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset."""
    spark = pieces.sparkSession
    pieces = materialize(pieces, "pieces")
    rows = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    histogram = {row["length"]: row["n"] for row in rows}
    slots = spark.sparkContext.broadcast(_slots(bin_patterns(histogram, capacity)))

    part = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SPREAD)).cast("int")
    parted = pieces.withColumn("part", part)
    sizes = parted.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = (
        Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    bases = sizes.select(
        "length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    order = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    numbered = parted.withColumn("inside", F.row_number().over(order) - 1)
    numbered = numbered.join(bases.hint("merge"), ["length", "part"])
    numbered = numbered.select(
        *pieces.columns, (F.col("base") + F.col("inside")).alias("number")
    )
    at, to = pieces.columns.index("length"), len(pieces.columns)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = slots.value
        # a number fits 44 bits, a length 19
        firsts = table["length"] << 44 | table["first"]
        for batch in batches:
            length = batch.column(at).to_numpy(zero_copy_only=False)
            number = batch.column(to).to_numpy(zero_copy_only=False)
            row = np.searchsorted(firsts, length << 44 | number, "right") - 1
            index = number - table["first"][row]
            each = table["each"][row]
            sequence = table["sequence"][row] + index // each
            offset = table["offset"][row] + index % each * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:to], pa.array(sequence), pa.array(offset)],
                names=[*batch.schema.names[:to], "sequence_id", "offset"],
            )

    fields = [f"`{n}` {t}" for n, t in pieces.dtypes]
    schema = ", ".join([*fields, "sequence_id bigint", "offset bigint"])
    return numbered.mapInArrow(place, schema)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Every document's pieces with the sequence that holds them and the place there."""
    pieces = token_pieces(docs, tokenizer, capacity, end_id, with_ids, key, text)
    return pack_pieces(pieces, capacity)
