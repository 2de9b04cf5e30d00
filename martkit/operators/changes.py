"""What changed between two states of a keyed table, with the rows before and after."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType

CHANGE, BEFORE, AFTER = "change_type", "before", "after"
INSERT, UPDATE, DELETE = "insert", "update", "delete"


def row_changes(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(change_type, key, before, after): one row per key that is not the same in both.

    The states have the same columns, and ``key`` is unique in each. ``before`` is null for
    an insert and ``after`` for a delete. Null values are equal to each other.
    """
    for field in before.schema.fields:
        if isinstance(field.dataType, MapType):
            raise ValueError(f"column {field.name} is a map, which cannot be compared")
    old = before.select(F.col(key), F.struct(*before.columns).alias(BEFORE))
    new = after.select(F.col(key), F.struct(*before.columns).alias(AFTER))
    return old.join(new, key, "full_outer").select(
        _kind().alias(CHANGE), key, BEFORE, AFTER
    ).where(F.col(CHANGE).isNotNull())


def _kind() -> Column:
    old, new = F.col(BEFORE), F.col(AFTER)
    return (
        F.when(old.isNull(), INSERT)
        .when(new.isNull(), DELETE)
        .when(~old.eqNullSafe(new), UPDATE)
    )


def flat(changes: DataFrame) -> DataFrame:
    """The images as columns ``before_x`` and ``after_x`` rather than structs."""
    images = [
        F.col(f"{side}.`{name}`").alias(f"{side}_{name}")
        for side in (BEFORE, AFTER)
        for name in _names(changes.schema, side)
    ]
    others = [c for c in changes.columns if c not in (BEFORE, AFTER)]
    return changes.select(*others, *images)


def _names(schema: StructType, side: str) -> list[str]:
    return schema[side].dataType.names
