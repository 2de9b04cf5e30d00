"""The hourly ingest, the daily rates and the daily mart.

Every job takes its window or date as an argument and can be run again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.functions.times import HourWindow
from martkit.operators.mart import build_mart, unmatched_sales
from martkit.operators.quality import assert_unique, unknown_scales
from martkit.schemas import MART_PARTITIONS, RATES_PARTITIONS
from martkit.session import materialize, require_utc
from martkit.sinks.catalog import missing_partitions, partitions_of, register_partitions
from martkit.sinks.zones import (
    EmptyOverwrite,
    PartialOverwrite,
    land_rates,
    land_raw,
    write_mart,
)
from martkit.sources.pages import Connect, bad_pages, fetch_pages, page_frame, parse_pages, stamp
from martkit.sources.rates import bad_documents, rates_from_documents, read_documents
from martkit.sources.zones import read_mart, read_rates, read_raw_day


class DamagedDocuments(ValueError):
    """Rate documents, or rates in them, cannot be read."""


def ingest_hour(
    spark: SparkSession,
    connect: Connect,
    total_pages: int,
    window: HourWindow,
    raw_root: str,
    secret: object = None,
    parallelism: int | None = None,
    files: int | None = None,
    on_error: str = "raise",
    allow_partial: bool = False,
    allow_empty: bool = False,
) -> DataFrame:
    """Fetch one hour of pages into the raw zone; gives the report on bad pages.

    The bodies are stored before they are parsed: each page is asked for once,
    and a lost executor later on cannot bring in a second, different answer.
    An hour that is there is replaced only by a whole one: if pages failed, or no sale
    came, this raises before anything is written unless it is told that this is fine.
    """
    require_utc(spark)
    pages = page_frame(spark, total_pages, parallelism)
    fetched = materialize(fetch_pages(pages, connect, secret, on_error), "pages")
    failed = fetched.agg(F.count("error")).first()[0]
    if failed and not allow_partial:
        raise PartialOverwrite(f"{failed} of {total_pages} pages failed; the hour is kept")
    sales = stamp(parse_pages(fetched), window)
    if not allow_empty and sales.isEmpty():
        raise EmptyOverwrite(f"no sales for {window.day} {window.hour}; the hour is kept")
    land_raw(sales, raw_root, window, files)
    return bad_pages(fetched)


def load_rates(
    spark: SparkSession,
    documents: str,
    rates_root: str,
    table: str | None = None,
    on_damage: str = "error",
) -> DataFrame:
    """Land rate snapshots, then register their days with ``table``.

    The documents are read once, and parsed again for the report on damaged ones,
    which is the result. Unless ``on_damage`` is ``"report"``, damage raises before
    anything is written.
    """
    if on_damage not in ("error", "report"):
        raise ValueError("on_damage is 'error' or 'report'")
    texts = materialize(read_documents(spark, documents), "rate-documents")
    damaged = bad_documents(texts)
    if on_damage == "error":
        listed = damaged.select("currency", "reason").limit(20).collect()
        if listed:
            raise DamagedDocuments(f"damaged rates: {[tuple(row) for row in listed]}")
    rates = materialize(rates_from_documents(texts), "rates")
    assert_unique(rates, ["retrieval_date", "currency"])
    land_rates(rates, rates_root)
    if table:
        days = partitions_of(rates, RATES_PARTITIONS)
        register_partitions(
            missing_partitions(days, table, RATES_PARTITIONS), table, RATES_PARTITIONS
        )
    return damaged


@dataclass(frozen=True)
class MartReport:
    """What a mart run let through; plain DataFrames, run only when looked at."""

    unmatched: DataFrame
    unknown_scales: DataFrame


def mart_day(
    spark: SparkSession,
    raw_root: str,
    rates_root: str,
    mart_root: str,
    day: str,
    currency: str = "JPY",
    on_duplicate: str = "error",
    allow_empty: bool = False,
    table: str | None = None,
) -> MartReport:
    """Build, check, write and register the mart of one day.

    Rates are checked for repeats first, as one would multiply the sales. The
    uniqueness check reads one column of the mart and shuffles keys and partial
    counts; a look for rows of other days reads their statistics, or one column where
    files have none; the rows themselves are read once more, for the write.
    """
    require_utc(spark)
    sales = read_raw_day(spark, raw_root, day)
    rates = read_rates(spark, rates_root, day)
    assert_unique(rates, ["retrieval_date", "currency"])
    mart = build_mart(sales, rates, currency)
    assert_unique(mart, ["purchase_id"], on_duplicate)
    write_mart(mart, mart_root, day, allow_empty)
    if table:
        written = read_mart(spark, mart_root, day)
        present = partitions_of(written, MART_PARTITIONS)
        register_partitions(
            missing_partitions(present, table, MART_PARTITIONS), table, MART_PARTITIONS
        )
    return MartReport(unmatched_sales(sales, rates, currency), unknown_scales(sales))
