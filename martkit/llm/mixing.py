"""Mixing sources to target weights by Poisson replication.

A source s gets the mean repetition rate target_bytes * weight_s / bytes_s. Each
document draws its number of copies from a Poisson distribution with that mean, by
inverting the distribution at a number hashed from seed and document id; it is then
exploded by that count, and all copies are shuffled globally.

A document that is repeated very often, as one of a tiny source with a large share is,
is dealt out in lots of copies first, so that no task makes all of them.

Null sources form one source of their own. A source without a weight gets none.
Sizes are UTF-8 bytes plus one, so empty and null texts weigh something. Repeated ids
draw the same number; a null id draws by its text. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from martkit.llm.common import hex_number, quoted
from martkit.operators.joins import lookup_join
from martkit.session import materialize

# A mean above this is split into equal parts that are drawn one by one and added,
# which is the same distribution and keeps exp(-mean) well above zero.
PART_MEAN = 16.0
# No draw of 52 bits lies beyond so many values for a part.
MOST = int(PART_MEAN + 14 * math.sqrt(PART_MEAN) + 40)

# Copies of a document that one task makes.
LOT = 1024
# A greater rate is refused: copies are counted by 32-bit numbers.
MOST_RATE = 1 << 30

SOURCE = "__mix_source"
RATE = "__mix_rate"
DRAW = "__mix_draw"
LOTS = "__mix_lot"
COPY = "copy"
COPIES = "n_copies"
SHUFFLE = "shuffle_key"


def source_rates(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    epochs: float = 1.0,
    source: str = "source",
    text: str = "text",
    max_rate: float | None = None,
) -> DataFrame:
    """(source, n_docs, bytes, rate), one row per source.

    ``weights`` need not add up to one; without them all sources weigh the same.
    ``epochs`` times the bytes of the table is the expected size of the mix. ``max_rate``
    bounds how often a document is repeated on average; sources that it holds back fall
    short of their share.
    """
    size = F.coalesce(F.octet_length(quoted(text)), F.lit(0)).cast("bigint") + 1
    sizes = docs.select(quoted(source).alias("source"), size.alias("size")).groupBy("source")
    sizes = sizes.agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("bytes"))
    sizes = materialize(sizes, "mix-sizes")
    if weights is None:
        weighed = sizes.withColumn("weight", F.lit(1.0))
    else:
        schema = StructType(
            [StructField("name", StringType()), StructField("weight", DoubleType())]
        )
        given = [(k, float(v)) for k, v in weights.items()]
        if any(v < 0 or not math.isfinite(v) for _, v in given):
            raise ValueError("weights must be finite and not negative")
        wanted = docs.sparkSession.createDataFrame(given, schema)
        weighed = sizes.join(wanted, sizes["source"].eqNullSafe(wanted["name"]), "left")
        weighed = weighed.withColumn("weight", F.coalesce("weight", F.lit(0.0))).drop("name")
    totals = weighed.agg(F.sum("bytes"), F.sum("weight")).first()
    all_bytes, all_weight = totals[0] or 0, totals[1] or 0.0
    share = F.col("weight") / F.lit(all_weight or 1.0)
    rate = F.lit(float(epochs)) * F.lit(float(all_bytes)) * share / F.col("bytes")
    if max_rate is not None:
        rate = F.least(rate, F.lit(float(max_rate)))
    rates = weighed.select("source", "n_docs", "bytes", rate.alias("rate"))
    greatest = rates.agg(F.max("rate")).first()[0] or 0.0
    if greatest > MOST_RATE:
        raise ValueError(f"a source would be repeated {greatest:.3g} times; set max_rate")
    return rates


def poisson(mean: Column, draw: Column, seed: int) -> Column:
    """Smallest k whose distribution function reaches a number hashed from ``draw``."""
    parts = F.greatest(F.lit(1), F.ceil(mean / PART_MEAN)).cast("int")
    own = mean / parts

    def one(part: Column) -> Column:
        digest = F.md5(F.concat_ws(":", F.lit(str(seed)), draw, part.cast("string")))
        u = (hex_number(digest, 13) + F.lit(0.5)) / F.lit(float(1 << 52))
        p0 = F.exp(-own)
        start = F.struct(F.lit(0).alias("k"), p0.alias("p"), p0.alias("sum"), u.alias("u"))

        def step(acc: Column, k: Column) -> Column:
            p = acc["p"] * own / k
            more = F.struct(
                k.alias("k"), p.alias("p"), (acc["sum"] + p).alias("sum"), acc["u"].alias("u")
            )
            return F.when(acc["sum"] >= acc["u"], acc).otherwise(more)

        ks = F.sequence(F.lit(1), F.lit(MOST))
        return F.aggregate(ks, start, step, lambda acc: acc["k"])

    drawn = F.transform(F.sequence(F.lit(1), parts), one)
    total = F.aggregate(drawn, F.lit(0), lambda a, b: a + b)
    return F.when(mean > 0, total).otherwise(F.lit(0))


def mix_sources(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    epochs: float = 1.0,
    seed: int = 42,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    max_rate: float | None = None,
) -> DataFrame:
    """All columns of ``docs`` with ``copy`` (from 1), ``n_copies`` and ``shuffle_key``.

    Rows come in a random order: dealt to partitions and sorted there by hashes of
    seed, id and copy. Sorting by ``shuffle_key`` gives one order for all.
    Input columns of those three names are replaced.
    """
    rates = source_rates(docs, weights, epochs, source, text, max_rate)
    rates = rates.select(
        F.concat_ws("", F.lit("s"), "source").alias(SOURCE),
        F.col("source").isNull().alias(SOURCE + "_null"),
        F.col("rate").alias(RATE),
    )
    columns = [c for c in docs.columns if c not in (COPY, COPIES, SHUFFLE)]
    name = quoted(source)
    rows = docs.withColumn(SOURCE, F.concat_ws("", F.lit("s"), name))
    rows = rows.withColumn(SOURCE + "_null", name.isNull())
    rows = lookup_join(rows, rates, [SOURCE, SOURCE + "_null"], "inner")
    draw = F.coalesce(quoted(key).cast("string"), F.md5(F.coalesce(quoted(text), F.lit(""))))
    rows = rows.withColumn(DRAW, draw)
    rows = rows.withColumn(COPIES, poisson(F.col(RATE), F.col(DRAW), seed))
    few = rows.where((F.col(COPIES) > 0) & (F.col(COPIES) <= LOT))
    few = few.withColumn(COPY, F.explode(F.sequence(F.lit(1), F.col(COPIES))))
    last = F.floor((F.col(COPIES) - 1) / LOT).cast("int")
    lots = rows.where(F.col(COPIES) > LOT)
    lots = lots.withColumn(LOTS, F.explode(F.sequence(F.lit(0), last)))
    lots = lots.repartition(DRAW, LOTS)
    begin = F.col(LOTS) * LOT
    own = F.sequence(begin + 1, F.least(begin + LOT, F.col(COPIES)))
    rows = few.unionByName(lots.withColumn(COPY, F.explode(own)).drop(LOTS))
    digest = F.md5(F.concat_ws(":", F.lit(f"{seed}s"), F.col(DRAW), F.col(COPY).cast("string")))
    rows = rows.withColumn(SHUFFLE, hex_number(digest, 15))
    mixed = rows.select(*[quoted(c) for c in columns], COPY, COPIES, SHUFFLE)
    return mixed.repartition(F.col(SHUFFLE)).sortWithinPartitions(SHUFFLE)
