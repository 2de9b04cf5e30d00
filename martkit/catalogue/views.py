"""Sales, rates, changes, places and points, derived from the given tables.

All literals are exact binary fractions, so that both engines multiply alike.
``oracles.py`` states the same views in SQL.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.functions.times import local_day
from martkit.operators.versioned import COMMIT, DELETED
from martkit.schemas import RAW_SALES
from martkit.session import configure, materialize
from martkit.sources.rates import rates_from_documents

# A day left without rates, so that its sales find no match.
RATELESS_DAY = "2024-01-07"

PAGE_SIZE = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def naive(df: DataFrame) -> DataFrame:
    """Timestamps as zone-less UTC, days as text; both engines print them alike."""
    kinds = {"timestamp": "timestamp_ntz", "date": "string"}
    return df.select(
        *[
            F.col(name).cast(kinds[kind]).alias(name) if kind in kinds else F.col(name)
            for name, kind in df.dtypes
        ]
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw sales."""
    store = F.col("user_id") % 20
    scale = (
        F.when(F.col("event_type") == "purchase", "us_doller")
        .when(F.col("event_type") == "click", "pound")
        .when(F.col("event_type") == "error", None)
        .otherwise("yen")
    )
    time = F.col("ts").cast("timestamp")
    columns = {
        "page": F.expr(f"event_id div {PAGE_SIZE} + 1"),
        "store_id": store,
        "purchase_id": F.col("event_id").cast("string"),
        "scale": scale,
        "store_name": F.concat(F.lit("Store "), F.char(store + 65)),
        "time": time,
        "sales": F.col("value"),
        "retrieval_date": local_day(time),
    }
    events = table(spark, sf_dir, "events")
    return events.select(
        *[columns[f.name].cast(f.dataType).alias(f.name) for f in RAW_SALES.fields]
    )


def rate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rate snapshot per sales day, taken the day after at 01:00 local time."""
    day = local_day(F.col("ts").cast("timestamp")).alias("day")
    days = table(spark, sf_dir, "events").select(day).distinct()
    day = F.col("day")
    rates = F.to_json(
        F.struct(
            (F.unix_timestamp(day.cast("timestamp")) + 16 * 3600).alias("timestamp"),
            F.struct(
                (F.dayofmonth(day) * 0.25 + 150).alias("JPY"),
                F.lit(0.9375).alias("EUR"),
                F.lit(1).alias("USD"),
            ).alias("rates"),
        )
    )
    return days.where(day != F.lit(RATELESS_DAY).cast("date")).select(rates.alias("value"))


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshots as a table, stored so that the sales days are found once."""
    return materialize(rates_from_documents(rate_documents(spark, sf_dir)), "rates")


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the log of a table keyed by user, one commit per day."""
    return table(spark, sf_dir, "events").select(
        "user_id",
        "event_type",
        "value",
        "ts",
        "event_id",
        (F.col("event_type") == "error").alias(DELETED),
        F.date_format("ts", "yyyyMMdd").alias(COMMIT),
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as overlapping boxes of unequal area that cover every point."""
    key = F.col("n_nationkey")
    south, west = key % 5 * 36.0 - 90, F.floor(key / 5) * 72.0 - 180
    return table(spark, sf_dir, "nation").select(
        "n_nationkey",
        "n_name",
        south.alias("south"),
        (south + 40).alias("north"),
        west.alias("west"),
        (west + 72 + key % 3 * 8).alias("east"),
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as points, both as numbers and as request text."""
    key = F.col("c_custkey")
    located = table(spark, sf_dir, "customer").select(
        "c_custkey",
        (key % 180 - 90 + 0.5).cast("double").alias("lat"),
        (key * 7 % 360 - 180 + 0.5).cast("double").alias("lon"),
    )
    latlon = F.concat(
        F.lit("lat="), F.col("lat").cast("string"), F.lit("&lon="), F.col("lon").cast("string")
    )
    return located.withColumn("latlon", latlon)


def page_client(secret):
    """A stand-in for the sales API: two sales per page, from the page number."""

    def body(page: int) -> str:
        time = "2024-06-12T19:15:30.123Z"
        shared = {"store_id": page % 20, "store_name": secret, "time": time}
        sold = [
            {**shared, "purchase_id": f"A{page}", "sales": page, "scale": "yen"},
            {**shared, "purchase_id": f"B{page}", "sales": page * 0.5, "scale": "us_doller"},
        ]
        return json.dumps({"page": page, "per_page": 2, "data": sold})

    return body


def geo_client():
    """A stand-in for the geocoder: one place per degree cell, none near the south pole."""

    def answer(latlon: str) -> tuple[int, str]:
        parts = dict(part.split("=") for part in latlon.split("&"))
        south, west = int(float(parts["lat"]) // 1), int(float(parts["lon"]) // 1)
        if south < -80:
            return 404, json.dumps({"error": "Unable to geocode"})
        box = [str(bound) for bound in (south, south + 1, west, west + 1)]
        place_id = (south + 90) * 360 + west + 180
        place = {"place_id": place_id, "name": f"cell {place_id}", "boundingbox": box}
        return 200, json.dumps(place)

    return answer
