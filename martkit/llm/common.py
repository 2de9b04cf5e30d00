"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spark ends an Arrow batch at so many bytes, so that long texts do not add up.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds by size as well as by rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def hex_number(text: Column, digits: int) -> Column:
    """The first ``digits`` (at most 15) hex digits of ``text`` as a bigint."""
    return F.conv(F.substring(text, 1, digits), 16, 10).cast("bigint")


def worker_store() -> dict[str, Any]:
    """A dictionary that lives as long as the Python worker does.

    Functions are shipped by value, so their module globals are made anew in
    each task; what is costly to load is kept here instead.
    """
    module = sys.modules.setdefault("_martkit_worker", types.ModuleType("_martkit_worker"))
    return module.__dict__.setdefault("store", {})


def once(key: str, make: Callable[[], Any]) -> Any:
    """``make()``, called once in each Python worker and kept until another key is asked for.

    Workers outlive queries, so keeping what each of them remembers would add up.
    """
    store = worker_store()
    if key not in store:
        store.clear()
        store[key] = make()
    return store[key]
