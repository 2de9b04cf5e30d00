"""The daily mart by write, audit and publish, with all its audits in one pass."""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.functions.money import KNOWN_SCALES
from martkit.functions.times import LOCAL_ZONE
from martkit.operators.history import repeated_across_days
from martkit.operators.joins import lookup_join
from martkit.operators.mart import convert_to_yen, currency_rates, split_local_time
from martkit.operators.quality import DuplicateKeys, assert_unique
from martkit.schemas import MART
from martkit.session import require_utc
from martkit.sinks.publish import Published, Run, audit_run, publish_run, write_run
from martkit.sources.zones import read_rates, read_raw_day

MATCHED = "__matched"

# Repeated keys that a message names.
LISTED = 20


@dataclass(frozen=True)
class DayReport:
    """What a run counted and how the table changed.

    ``counted``: rows written; sales read, and of these ``unmatched`` for want of a rate,
    ``unknown_scales`` and ``null_scales`` counted as yen, ``null_ids``, ``null_times`` and
    ``null_sales``.
    """

    run: Run
    published: Published

    @property
    def counted(self) -> Mapping[str, int]:
        return self.run.counted


def priced_sales(
    sales: DataFrame, rates: DataFrame, currency: str = "JPY", zone: str = LOCAL_ZONE
) -> DataFrame:
    """Mart rows of all sales, those without a rate too; ``__matched`` tells them apart."""
    own = currency_rates(rates, currency).select("retrieval_date", "rates")
    own = own.withColumn(MATCHED, F.lit(True))
    priced = lookup_join(sales, own, ["retrieval_date"], "left")
    local = priced.transform(convert_to_yen).transform(split_local_time, zone)
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in MART.fields]
    return local.select(*columns, F.coalesce(MATCHED, F.lit(False)).alias(MATCHED))


def audit_metrics() -> dict[str, F.Column]:
    """Figures about all sales that were read, taken while the mart is written."""
    scale = F.col("scale")
    return {
        "sales_read": F.count(F.lit(1)),
        "unmatched": F.count_if(~F.col(MATCHED)),
        "unknown_scales": F.count_if(~scale.isin(*KNOWN_SCALES)),
        "null_scales": F.count_if(scale.isNull()),
        "null_ids": F.count_if(F.col("purchase_id").isNull()),
        "null_times": F.count_if(F.col("time").isNull()),
        "null_sales": F.count_if(F.col("sales").isNull()),
    }


def publish_day(
    spark: SparkSession,
    raw_root: str,
    rates_root: str,
    mart_root: str,
    day: str,
    table: str,
    currency: str = "JPY",
    on_duplicate: str = "error",
    on_replay: str = "error",
    since: str | None = None,
    max_unmatched: int | None = None,
    allow_empty: bool = False,
    run: str | None = None,
) -> DayReport:
    """Build, write, audit and publish the mart of one day; the table shows it last of all.

    The raw zone is read once. Unmatched sales, unknown units, nulls and rows are counted in
    the tasks that write; repeated ids are looked for in what was written, and among the
    other days that the table shows (from ``since`` on) for a page that came again under
    another date. ``max_unmatched`` bounds the sales that may lack a rate.

    Whatever fails, the table shows the day as before.
    """
    if on_replay not in ("error", "warn", "ignore"):
        raise ValueError("on_replay is 'error', 'warn' or 'ignore'")
    require_utc(spark)
    rates = read_rates(spark, rates_root, day)
    assert_unique(rates, ["retrieval_date", "currency"])
    rows = priced_sales(read_raw_day(spark, raw_root, day), rates, currency)
    written = write_run(rows, mart_root, day, run, F.col(MATCHED), audit_metrics())
    unmatched = written.counted["unmatched"]
    if max_unmatched is not None and unmatched > max_unmatched:
        raise ValueError(f"{unmatched} sales of {day} have no rate; the day is kept")
    audit_run(spark, written, on_duplicate, allow_empty)
    if on_replay != "ignore":
        _check_replays(spark, written, table, since, on_replay)
    return DayReport(written, publish_run(spark, written, table))


def replays(spark: SparkSession, run: Run, table: str, since: str | None = None) -> DataFrame:
    """Ids of a run that the table shows on other days, with these days."""
    others = spark.table(table).where(F.col("retrieval_date") != run.day)
    if since is not None:
        others = others.where(F.col("retrieval_date") >= since)
    return repeated_across_days(run.rows(spark), others)


def _check_replays(
    spark: SparkSession, run: Run, table: str, since: str | None, on_replay: str
) -> None:
    again = replays(spark, run, table, since)
    listed = [tuple(row) for row in again.limit(LISTED).collect()]
    if not listed:
        return
    message = f"ids of {run.day} are shown on other days: {listed}"
    if on_replay == "error":
        raise DuplicateKeys(message, again)
    warnings.warn(message, stacklevel=3)
