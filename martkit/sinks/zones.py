"""Writers of the raw and gold zones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.functions.times import HourWindow


class EmptyOverwrite(ValueError):
    """The new data is empty and would replace what is there."""


class PartialOverwrite(ValueError):
    """The new data is known to be incomplete and would replace what is there."""


def land_raw(sales: DataFrame, root: str, window: HourWindow, files: int | None = None) -> str:
    """Write one hour to ``root/day/hour``; writing it again replaces it.

    By default the rebalance hint sizes the files to the session's advisory
    partition size, so an hour of any volume gives few but bounded files.
    ``files`` asks for an exact number, sensible for small hours only.
    """
    path = f"{root}/{window.day}/{window.hour}"
    sized = sales.repartition(files) if files else sales.hint("rebalance")
    sized.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def land_rates(rates: DataFrame, root: str) -> None:
    """Write each snapshot day under ``root/retrieval_date=day``, replacing it."""
    (
        rates.select("currency", "rates", "retrieval_date")
        .repartition("retrieval_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("retrieval_date")
        .parquet(root)
    )


def write_mart(
    mart: DataFrame,
    root: str,
    day: str,
    allow_empty: bool = False,
    sort_by_time: bool = False,
) -> str:
    """Replace the mart of one day, partitioned by store.

    Stores that the new rows lack disappear. The date is kept in the path only.
    The rebalance hint brings a store's rows together, so that a store gets few
    files, but splits one larger than the advisory size over several tasks.
    ``sort_by_time`` sorts the rows of a file, for readers that filter by time.
    """
    other_day = ~F.col("retrieval_date").eqNullSafe(F.lit(day))
    if not mart.where(other_day).isEmpty():
        raise ValueError(f"the mart holds rows of other days than {day}")
    if not allow_empty and mart.isEmpty():
        raise EmptyOverwrite(f"no mart rows for {day}; the stored ones are kept")
    path = f"{root}/retrieval_date={day}"
    writer = _partitioned(mart.drop("retrieval_date"), ["store_id"], sort_by_time)
    # whatever the session's mode is, stores that are gone have to go
    writer.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return path


def write_mart_days(mart: DataFrame, root: str) -> None:
    """Replace exactly the (day, store) partitions that ``mart`` holds.

    For back-fills over many days in one job. Unlike :func:`write_mart` a store
    without new rows keeps its old ones.
    """
    writer = _partitioned(mart, ["retrieval_date", "store_id"])
    writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(root)


def _partitioned(rows: DataFrame, keys: list[str], sort_by_time: bool = False):
    placed = rows.hint("rebalance", *keys)
    if sort_by_time:
        placed = placed.sortWithinPartitions(*keys, "time")
    return placed.write.option("compression", "snappy").partitionBy(*keys)
