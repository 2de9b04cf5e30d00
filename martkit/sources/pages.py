"""Paged JSON API: enumerate, fetch in parallel, parse, report damage."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from martkit.functions.times import HourWindow
from martkit.schemas import ENVELOPE, FETCHED
from martkit.sources.batches import frames
from martkit.sources.polite import Retry, polite

# ``Connect`` runs once per task with the secret and gives a client that turns
# a page number into the page body; a connection is thus shared by a task.
Client = Callable[[int], str]
Connect = Callable[[object], Client]

CORRUPT = "_corrupt_record"


def page_count(client: Client) -> int:
    """Number of pages, as the first page states it."""
    return int(json.loads(client(1))["total_pages"])


def page_frame(spark: SparkSession, total_pages: int, parallelism: int | None = None) -> DataFrame:
    """One row per page; ``parallelism`` bounds the requests in flight."""
    return spark.range(1, total_pages + 1, numPartitions=parallelism).toDF("page")


def fetch_pages(
    pages: DataFrame,
    connect: Connect,
    secret: object = None,
    on_error: str = "raise",
    retry: Retry | None = None,
) -> DataFrame:
    """Fetch the body of every page on the executors.

    With ``retry`` a call that raises is made again before the page counts as failed.

    ``on_error="empty"`` gives a failing page no body but the ``error``, which
    :func:`bad_pages` then lists; ``"raise"`` fails the task, which Spark
    retries.
    """
    if on_error not in ("raise", "empty"):
        raise ValueError("on_error is 'raise' or 'empty'")
    shared = pages.sparkSession.sparkContext.broadcast(secret)

    def body(client: Client, page: int) -> tuple[str | None, str | None]:
        try:
            return client(page), None
        except Exception as error:
            if on_error == "raise":
                raise
            return None, f"{type(error).__name__}: {error}"[:1000]

    def fetch(batches):
        client = polite(connect(shared.value), retry)
        for batch in batches:
            fetched = ((page, *body(client, page)) for page in batch["page"].tolist())
            yield from frames(fetched, FETCHED.names)

    return pages.select("page").mapInPandas(fetch, FETCHED)


def parse_pages(fetched: DataFrame) -> DataFrame:
    """One row per sale; a damaged or empty page gives no row.

    From a plain explode Spark infers a filter on the array, and evaluates the
    JSON parser once more for it. The outer form, with the pages that gave
    nothing taken out afterwards, parses every body once.
    """
    envelopes = fetched.select("page", F.from_json("sales_data", ENVELOPE).alias("sales_data"))
    sales = envelopes.select("page", F.posexplode_outer("sales_data.data").alias("at", "data"))
    return sales.where(F.col("at").isNotNull()).select("page", "data.*")


def bad_pages(fetched: DataFrame) -> DataFrame:
    """Pages that gave no sale, or a sale with a damaged field, and why.

    The reason passes through a one-element explode: a filter on a plain column
    would be moved below the parser, with a copy of it for every mention.
    """
    schema = StructType([*ENVELOPE.fields, StructField(CORRUPT, StringType())])
    parsed = F.from_json("sales_data", schema, {"columnNameOfCorruptRecord": CORRUPT})
    # bodies from elsewhere need not tell of errors
    error = F.col("error") if "error" in fetched.columns else F.lit(None).cast("string")
    parsed = fetched.select("page", "sales_data", error.alias("error"), parsed.alias("envelope"))
    reasons = parsed.select("page", F.explode(F.array(_reason())).alias("reason"))
    return reasons.where(F.col("reason").isNotNull())


def _reason() -> Column:
    data = F.col("envelope.data")
    damaged = F.col(f"envelope.{CORRUPT}").isNotNull()
    return (
        F.when(F.col("error").isNotNull(), "failed")
        .when(F.col("sales_data").isNull(), "missing")
        .when(F.col("envelope").isNull() | (damaged & data.isNull()), "unparsable")
        .when(data.isNull(), "no data")
        .when(F.size(data) == 0, "empty")
        .when(damaged, "bad field")
    )


def stamp(sales: DataFrame, window: HourWindow) -> DataFrame:
    """Mark the rows with the local date of the window they were fetched for."""
    return sales.withColumn("retrieval_date", F.lit(window.day))
