"""Joins of many rows to a keyed lookup that stay sound under skew.

A lookup is broadcast only after its size was measured. A larger one is joined
by shuffle, with the rows of hot keys spread over salts: a key that holds a third
of all rows then still gives tasks of ordinary size, and nothing is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, NumericType, StringType

from martkit.session import materialize

# A lookup within both bounds is broadcast.
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 64 << 20

# A key is hot when it holds more than one HOT_SHARES-th of the rows, so there
# are fewer than HOT_SHARES hot keys whatever the volume, and they can be
# broadcast. Keys of fewer than HOT_ROWS rows are never hot.
HOT_SHARES = 100_000
HOT_ROWS = 100_000

# Spread of the rows with a null key, which match nothing.
NULL_SALTS = 1 << 16

WEIGHT = "__weight"
SALT = "__salt"
SALTS = "__salts"


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, approximate bytes), found by one partial aggregation."""
    width = F.lit(0).cast("bigint")
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (StringType, BinaryType)):
            width = width + F.coalesce(F.octet_length(column), F.lit(0)) + 8
        elif isinstance(field.dataType, NumericType):
            width = width + 8
        else:
            text = F.to_json(F.struct(column))
            width = width + F.coalesce(F.octet_length(text), F.lit(0)) + 8
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("size")).first()
    return row["n"], row["size"] or 0


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    rows, size = measure(df)
    return rows <= max_rows and size <= max_bytes


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    how: str = "left",
    weights: DataFrame | None = None,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join ``lookup`` to ``rows`` on equally named keys.

    ``how`` is ``left``, ``inner`` or ``left_anti``. ``weights`` (the keys and
    ``__weight``, the number of rows of each) saves counting them when the
    caller has the figures; keys it lacks count as not hot. ``rows`` should be
    a scan or narrow steps over one: the salts follow row positions, which a
    re-run of a scan repeats.
    """
    if how not in ("left", "inner", "left_anti"):
        raise ValueError(f"unsupported join: {how}")
    payload = [] if how == "left_anti" else [c for c in lookup.columns if c not in keys]
    if fits_broadcast(lookup, max_rows, max_bytes):
        joined = rows.join(F.broadcast(lookup), keys, how)
        return joined.select(*rows.columns, *payload)

    if weights is None:
        weights = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(WEIGHT))
        weights = materialize(weights, "weights")
    hot = F.broadcast(_hot_keys(weights, keys, hot_rows))

    position = F.monotonically_increasing_id()
    null_key = F.greatest(*[F.col(k).isNull().cast("int") for k in keys] + [F.lit(0)]) == 1
    spread = (
        F.when(F.col(SALTS).isNotNull(), F.pmod(position, F.col(SALTS)))
        .when(null_key, F.pmod(position, F.lit(NULL_SALTS)))
        .otherwise(F.lit(0))
    )
    salted_rows = rows.join(hot, keys, "left").withColumn(SALT, spread).drop(SALTS)
    copies = F.sequence(F.lit(0), F.coalesce(F.col(SALTS), F.lit(1)) - 1)
    salted_lookup = lookup.join(hot, keys, "left").withColumn(SALT, F.explode(copies))
    salted_lookup = salted_lookup.withColumn(SALT, F.col(SALT).cast("bigint")).drop(SALTS)
    joined = salted_rows.join(salted_lookup, [*keys, SALT], how)
    return joined.select(*rows.columns, *payload)


def _hot_keys(weights: DataFrame, keys: list[str], hot_rows: int) -> DataFrame:
    """Hot keys and the number of salts each gets, fewer than HOT_SHARES rows."""
    total = weights.agg(F.sum(WEIGHT)).first()[0] or 0
    share = max(hot_rows, total / HOT_SHARES)
    named = weights.where(F.col(WEIGHT) > share).dropna(subset=keys)
    return named.select(*keys, F.ceil(F.col(WEIGHT) / share).cast("int").alias(SALTS))
