"""Key uniqueness and value checks that gate a write."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.functions.money import KNOWN_SCALES
from martkit.operators.joins import BROADCAST_ROWS, HOT_ROWS, WEIGHT, lookup_join
from martkit.session import materialize


COUNT = "__count"


class DuplicateKeys(ValueError):
    """Keys that should be unique are not; ``keys`` holds all of them, with counts."""

    def __init__(self, message: str, keys: DataFrame | None = None):
        super().__init__(message)
        self.keys = keys


def key_counts(
    df: DataFrame,
    key: str,
    name: str = "count",
    max_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every row with the number of rows of its key; a null key counts 0.

    The result is that of ``count(key) over (partition by key)``, but a window
    moves every row, with all its columns, to the one task of its key. Here keys
    and partial counts are shuffled, and only repeated keys are joined back. A column
    ``name`` of the input is replaced.
    """
    repeated = df.groupBy(key).agg(F.count(key).alias(COUNT)).where(F.col(COUNT) > 1)
    repeated = materialize(repeated, "key-counts")
    weights = repeated.select(key, F.col(COUNT).alias(WEIGHT))
    counted = lookup_join(
        df, repeated, [key], weights=weights, max_rows=max_rows, hot_rows=hot_rows
    )
    alone = F.when(F.col(key).isNull(), F.lit(0)).otherwise(F.lit(1))
    return counted.withColumn(name, F.coalesce(F.col(COUNT), alone).cast("bigint")).drop(COUNT)


def duplicate_keys(
    df: DataFrame, keys: list[str], nulls_as_violation: bool = False, name: str = "count"
) -> DataFrame:
    """Keys held by more than one row and how often; aggregation only.

    A key with a null part is no violation unless ``nulls_as_violation``.
    """
    if not nulls_as_violation:
        df = df.dropna(subset=keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)


def assert_unique(
    df: DataFrame,
    keys: list[str],
    on_fail: str = "error",
    max_listed: int = 20,
    nulls_as_violation: bool = False,
) -> None:
    """Raise, or warn, naming up to ``max_listed`` of the repeated keys in the message.

    The exception's ``keys`` is a DataFrame of all of them.
    """
    if on_fail not in ("error", "warn"):
        raise ValueError("on_fail is 'error' or 'warn'")
    every = duplicate_keys(df, keys, nulls_as_violation)
    found = every.limit(max_listed + 1).collect()
    if not found:
        return
    listed = [row[keys[0]] if len(keys) == 1 else tuple(row)[: len(keys)] for row in found]
    more = " and more" if len(listed) > max_listed else ""
    message = f"non-unique {', '.join(keys)}: {listed[:max_listed]}{more}"
    if on_fail == "error":
        raise DuplicateKeys(message, every)
    warnings.warn(message, stacklevel=2)


def unknown_scales(sales: DataFrame) -> DataFrame:
    """Rows per unit that is unknown or null, and so was counted as yen."""
    known = F.coalesce(F.col("scale").isin(*KNOWN_SCALES), F.lit(False))
    return sales.where(~known).groupBy("scale").agg(F.count(F.lit(1)).alias("rows"))
