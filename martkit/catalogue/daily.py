"""Queries over the published mart, changes of versioned tables and what is kept up to date.

Each has its SQL beside it; ``oracles.py`` states the views that they share.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.catalogue.oracles import ARRIVED, RATES, SALES, TO_MART
from martkit.catalogue.queries import DAYS, WINDOWS, _ingested, mart
from martkit.catalogue.views import naive, rates, sales
from martkit.operators.history import repeated_across_days
from martkit.operators.quality import DuplicateKeys
from martkit.plans.publish import publish_day
from martkit.schemas import MART, MART_PARTITIONS
from martkit.session import materialize, scratch_path
from martkit.sinks.catalog import (
    create_table,
    partitions_of,
    reconcile_partitions,
    registered_partitions,
)
from martkit.sinks.zones import land_rates, write_mart
from martkit.sources.zones import read_mart


class _Table:
    """A mart table in a database of its own, dropped at the end; the files outlast it."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = scratch_path(spark, "mart")
        self.database = f"money_{uuid.uuid4().hex}"
        self.name = f"{self.database}.salesdata"

    def __enter__(self) -> _Table:
        create_table(self.spark, self.name, MART, MART_PARTITIONS, self.root)
        return self

    def __exit__(self, *_) -> None:
        self.spark.sql(f"DROP DATABASE {self.database} CASCADE")


def _dated_rates(spark: SparkSession, sf_dir: str, days: list[str]) -> str:
    """The highest rate of each currency, as the rates of the given days."""
    root = scratch_path(spark, "rates")
    highest = rates(spark, sf_dir).groupBy("currency").agg(F.max("rates").alias("rates"))
    dated = F.explode(F.array(*[F.lit(day) for day in days]))
    land_rates(highest.withColumn("retrieval_date", dated), root)
    return root


# -- catalog and publication --------------------------------------------------


def partition_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 K7: a day's partitions after its mart was replaced by one of fewer, other stores"""
    with _Table(spark) as table:
        rows = mart(spark, sf_dir).withColumn("retrieval_date", F.lit(DAYS[0]))
        rows = materialize(rows, "mart-rows")
        shown = []
        few = rows.where(F.col("store_name") < "Store K")
        moved = few.withColumn("store_id", F.concat(F.lit("new "), F.col("store_id")))
        for state in (rows, few.where(F.col("store_name") >= "Store F").unionByName(moved)):
            write_mart(state, table.root, DAYS[0])
            present = partitions_of(read_mart(spark, table.root, DAYS[0]), MART_PARTITIONS)
            done = reconcile_partitions(
                present, table.name, MART_PARTITIONS, {MART_PARTITIONS[0]: DAYS[0]}
            )
            shown.append(done)
        known = registered_partitions(spark, table.name, MART_PARTITIONS)
        known = materialize(known, "partitions")
    figures = {"added": shown[1].added, "dropped": shown[1].dropped}
    return known.withColumns({k: F.lit(v).cast("bigint") for k, v in figures.items()})


PARTITION_RECONCILIATION = f"""{TO_MART}, states AS (
  SELECT DISTINCT store_name >= 'Store F' AS late, store_id FROM mart
  WHERE store_name < 'Store K'
), present AS (
  SELECT store_id FROM states WHERE late UNION SELECT 'new ' || store_id FROM states
), before AS (SELECT DISTINCT store_id FROM mart)
SELECT '2024-02-01' AS retrieval_date, store_id,
  (SELECT count(*) FROM (FROM present EXCEPT FROM before)) AS added,
  (SELECT count(*) FROM (FROM before EXCEPT FROM present)) AS dropped
FROM present"""


def published_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 K7 Q1-Q4: days published from the raw zone, with their counts.

    One of them twice, first from a single hour and then from all.
    """
    raw, early = _ingested(spark, sf_dir), scratch_path(spark, "raw")
    hour = f"{DAYS[0]}/{WINDOWS[0].hour}"
    spark.read.parquet(f"{raw}/{hour}").write.parquet(f"{early}/{hour}")
    rates_root = _dated_rates(spark, sf_dir, DAYS)
    with _Table(spark) as table:
        counted = {}
        for zone, day in ((early, DAYS[0]), (raw, DAYS[0]), (raw, DAYS[1])):
            report = publish_day(spark, zone, rates_root, table.root, day, table.name)
            counted[day] = report.counted
        shown = spark.table(table.name)
        for figure in ("rows", "sales_read", "unmatched", "unknown_scales", "null_scales"):
            by_day = [F.lit(x) for day in DAYS for x in (day, counted[day][figure])]
            named = F.create_map(*by_day)[F.col("retrieval_date")]
            shown = shown.withColumn(f"n_{figure}", named.cast("bigint"))
        shown = materialize(shown, "published-days")
    return naive(shown)


PUBLISHED_DAYS = f"""{ARRIVED}, {RATES}, highest AS (
  SELECT max(rates) AS rates FROM rates WHERE currency = 'JPY')
SELECT CAST(page AS INTEGER) AS page, purchase_id, scale, store_name, time, a.sales,
  CASE WHEN scale = 'us_doller' THEN a.sales * rates ELSE a.sales END AS sales_jpy,
  strftime(time + INTERVAL 9 HOUR, '%Y-%m-%d') AS ymd,
  CAST(hour(time + INTERVAL 9 HOUR) AS VARCHAR) AS hh,
  a.retrieval_date, CAST(store_id AS VARCHAR) AS store_id,
  count(*) OVER day AS n_rows, count(*) OVER day AS n_sales_read, 0::BIGINT AS n_unmatched,
  count(*) FILTER (scale = 'pound') OVER day AS n_unknown_scales,
  count(*) FILTER (scale IS NULL) OVER day AS n_null_scales
FROM arrived a CROSS JOIN highest WINDOW day AS (PARTITION BY a.retrieval_date)"""


def refused_publications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 Q3 K2: a day that repeats ids of another one is refused, and the table keeps its own.

    Both days bring the same raw hours; ``ids`` counts what the refusal names, by day.
    """
    raw = _ingested(spark, sf_dir)
    again = DAYS[1]
    replayed = scratch_path(spark, "raw")
    for day in (DAYS[0], again):
        source = spark.read.parquet(f"{raw}/{DAYS[0]}/*")
        source.withColumn("retrieval_date", F.lit(day)).write.parquet(f"{replayed}/{day}/03")
    rates_root = _dated_rates(spark, sf_dir, DAYS)
    with _Table(spark) as table:
        publish_day(spark, replayed, rates_root, table.root, DAYS[0], table.name)
        try:
            publish_day(spark, replayed, rates_root, table.root, again, table.name)
            refused = spark.createDataFrame([], "purchase_id string, days array<string>")
        except DuplicateKeys as error:
            refused = error.keys
        seen = refused.select(F.explode("days").alias("retrieval_date"))
        named = seen.groupBy("retrieval_date").agg(F.count(F.lit(1)).alias("ids"))
        kept = spark.table(table.name).groupBy("retrieval_date").agg(F.count(F.lit(1)).alias("rows"))
        both = materialize(kept.join(named, "retrieval_date", "full"), "refused")
    return both


REFUSED_PUBLICATIONS = f"""{ARRIVED}
SELECT retrieval_date, count(*) AS ids, count(*) AS rows FROM arrived
WHERE retrieval_date = '2024-02-01' GROUP BY retrieval_date"""


def replayed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 A3: ids of sales that came again, among those of all days stored before"""
    root = scratch_path(spark, "keys")
    stored = sales(spark, sf_dir).select("purchase_id", "retrieval_date")
    stored.repartition("retrieval_date").write.partitionBy("retrieval_date").parquet(root)
    number = F.col("purchase_id").cast("bigint")
    new = stored.select(
        F.when(number % 97 == 0, F.col("purchase_id")).otherwise(F.concat(F.lit("n"), number))
        .alias("purchase_id")
    )
    found = repeated_across_days(new, spark.read.parquet(root))
    return found.select("purchase_id", F.array_join("days", ",").alias("days"))


REPLAYED_IDS = f"""WITH {SALES}
SELECT purchase_id, string_agg(DISTINCT retrieval_date, ',' ORDER BY retrieval_date) AS days
FROM sales WHERE CAST(purchase_id AS BIGINT) % 97 = 0 GROUP BY purchase_id"""


QUERIES = {
    "partition_reconciliation": partition_reconciliation,
    "published_days": published_days,
    "refused_publications": refused_publications,
    "replayed_ids": replayed_ids,
}

ORACLES = {
    "partition_reconciliation": PARTITION_RECONCILIATION,
    "published_days": PUBLISHED_DAYS,
    "refused_publications": REFUSED_PUBLICATIONS,
    "replayed_ids": REPLAYED_IDS,
}
