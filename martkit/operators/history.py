"""Keys that come again on another day, found without moving the days before."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.operators.joins import lookup_join
from martkit.session import materialize

# Bits of the filter per new key: a stored key passes by chance once in so many.
BITS_PER_KEY = 64
# The filter is broadcast, so it has at most 2 ** 29 bits (64 MiB). With more new keys than a
# quarter of that it would let too much pass, and all stored keys are joined.
LEAST_BITS, MOST_BITS = 15, 29

BUCKET, BITMAP = "__bucket", "__bitmap"


def filter_bits(keys: int) -> int | None:
    """The size of the filter for so many keys, as a power of two; None if none would help."""
    if keys > (1 << MOST_BITS) // 4:
        return None
    wanted = math.ceil(math.log2(max(keys, 1) * BITS_PER_KEY))
    return min(MOST_BITS, max(LEAST_BITS, wanted))


def _place(key: str, bits: int) -> Column:
    """A position from 1 to 2**bits, by hash."""
    return F.shiftrightunsigned(F.xxhash64(F.col(key)), 64 - bits) + 1


def key_bitmaps(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """(bucket, bitmap): the positions of all keys, 32,768 of them in a bitmap of 4 KiB."""
    place = _place(key, bits)
    return keys.groupBy(F.bitmap_bucket_number(place).alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias(BITMAP)
    )


def possibly_in(rows: DataFrame, bitmaps: DataFrame, key: str, bits: int) -> DataFrame:
    """Rows whose key has its bit set: all that were in, and few others. No shuffle."""
    place = _place(key, bits)
    at = F.bitmap_bit_position(place)
    placed = rows.withColumn(BUCKET, F.bitmap_bucket_number(place))
    found = placed.join(F.broadcast(bitmaps), BUCKET)
    byte = F.conv(F.hex(F.substring(F.col(BITMAP), F.floor(at / 8) + 1, F.lit(1))), 16, 10)
    return found.where(F.getbit(byte.cast("int"), F.pmod(at, F.lit(8)).cast("int")) == 1).select(
        *rows.columns
    )


def repeated_across_days(
    new: DataFrame, stored: DataFrame, key: str = "purchase_id", day: str = "retrieval_date"
) -> DataFrame:
    """(key, days): keys of ``new`` that ``stored`` holds too, and on which days.

    Only the key and day columns of the stored days are read. A bitmap of the new keys, of
    a bounded size, is broadcast to that scan, and what passes is joined exactly, so the
    stored days are never shuffled as a whole. Null keys are equal to nothing.
    """
    keys = new.select(key).where(F.col(key).isNotNull()).distinct()
    keys = materialize(keys, "new-keys")
    bits = filter_bits(keys.count())
    rows = stored.select(key, day)
    if bits is not None:
        # at most 2 ** bits / 32,768 bitmaps
        bitmaps = materialize(key_bitmaps(keys, key, bits), "key-bitmaps")
        rows = possibly_in(rows, bitmaps, key, bits)
    found = lookup_join(rows, keys, [key], "inner")
    return found.groupBy(key).agg(F.array_sort(F.collect_set(day)).alias("days"))
