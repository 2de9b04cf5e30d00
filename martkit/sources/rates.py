"""Exchange-rate snapshots: one JSON document with a map of currencies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.functions.times import snapshot_day
from martkit.schemas import RATES_DOCUMENT
from martkit.session import require_utc


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Landed snapshot files, one document (column ``value``) per file."""
    return spark.read.text(path, wholetext=True)


def rates_from_documents(documents: DataFrame) -> DataFrame:
    """(currency, rates, retrieval_date), one row per sound entry of each document.

    What :func:`bad_documents` lists is left out, and nothing else.
    """
    entries = _entries(documents).where(F.col("reason").isNull())
    return entries.select("currency", "rates", "retrieval_date")


def bad_documents(documents: DataFrame) -> DataFrame:
    """(value, currency, reason) of documents, or single rates in them, that are damaged."""
    entries = _entries(documents).where(F.col("reason").isNotNull())
    return entries.select("value", "currency", "reason").distinct()


def _entries(documents: DataFrame) -> DataFrame:
    """Entries of all documents, one without a currency for a document without any."""
    require_utc(documents.sparkSession)
    parsed = documents.select("value", F.from_json("value", RATES_DOCUMENT).alias("document"))
    entries = parsed.select(
        "value",
        F.col("document.timestamp").alias("timestamp"),
        F.explode_outer("document.rates").alias("currency", "text"),
    )
    rate = F.col("text").try_cast("double")
    reason = (
        F.when(F.col("timestamp").isNull() & F.col("currency").isNull(), "unparsable")
        .when(F.col("timestamp").isNull(), "no timestamp")
        .when(F.col("currency").isNull(), "no rates")
        .when(rate.isNull() | F.isnan(rate), "bad rate")
    )
    return entries.select(
        "value",
        "currency",
        rate.alias("rates"),
        snapshot_day(F.col("timestamp")).alias("retrieval_date"),
        reason.alias("reason"),
    )
