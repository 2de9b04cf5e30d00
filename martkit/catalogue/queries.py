"""The registered queries; every one runs over its whole tables."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.catalogue.views import (
    changes,
    geo_client,
    naive,
    page_client,
    places,
    points,
    rate_documents,
    rates,
    sales,
    table,
)
from martkit.functions.times import HourWindow, local_time
from martkit.operators.geo import (
    containing_boxes,
    enrich_points,
    locate,
    parse_latlon,
    parse_response,
    response_box,
)
from martkit.operators.mart import (
    build_mart,
    convert_to_yen,
    join_rates,
    split_local_time,
    unmatched_sales,
)
from martkit.operators.quality import duplicate_keys, key_counts, unknown_scales
from martkit.operators.rollup import sales_daily, sales_daily_by_date, sales_hourly
from martkit.operators.versioned import COMMIT, VersionedTable, live_rows
from martkit.plans.jobs import mart_day
from martkit.schemas import MART, MART_PARTITIONS
from martkit.session import materialize, require_utc, scratch_path
from martkit.sinks.catalog import (
    create_table,
    missing_partitions,
    partitions_of,
    register_partitions,
    registered_partitions,
)
from martkit.sinks.zones import land_rates, land_raw, write_mart, write_mart_days
from martkit.sources.pages import bad_pages, fetch_pages, page_frame, parse_pages, stamp
from martkit.sources.rates import bad_documents, rates_from_documents
from martkit.sources.zones import read_mart, read_rates, read_raw_day


# Sales whose ids share an envelope in json_pages_explode.
CHUNK = 100_000
# By default JSON is written with milliseconds.
EXACT_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}

# Hours of the jobs from end to end, and their local days.
WINDOWS = [
    HourWindow(datetime(2024, 2, day, hour, tzinfo=timezone.utc)) for day in (1, 2) for hour in (3, 4)
]
DAYS = ["2024-02-01", "2024-02-02"]

# Instants of the vt_ queries.
AS_OF = "20240115"
BEGIN, END = "20240110", "20240120"


# -- ingest ------------------------------------------------------------------


def page_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page number, with the sales it will bring."""
    pages = sales(spark, sf_dir).select("page")
    last = pages.agg(F.max("page")).first()[0]
    sold = pages.groupBy("page").agg(F.count(F.lit(1)).alias("sales_rows"))
    return page_frame(spark, last).join(sold, "page", "left")


def fetched_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per customer, fetched by a client on the executors."""
    pages = table(spark, sf_dir, "customer").select((F.col("c_custkey") + 1).alias("page"))
    return naive(parse_pages(fetch_pages(pages, page_client, "Store API")))


def json_pages_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales packed into page envelopes and unpacked again.

    Chunks of consecutive ids bound every envelope, even if one page had all rows.
    """
    record = F.struct("store_id", "purchase_id", "scale", "store_name", "time", "sales")
    chunk = F.expr(f"cast(purchase_id as bigint) div {CHUNK}")
    packed = (
        sales(spark, sf_dir)
        .select("page", record.alias("record"), chunk.alias("chunk"))
        .groupBy("page", "chunk")
        .agg(F.collect_list("record").alias("data"))
    )
    envelope = F.struct("page", F.size("data").alias("per_page"), "data")
    bodies = packed.select("page", F.to_json(envelope, EXACT_TIMES).alias("sales_data"))
    return naive(parse_pages(bodies))


def malformed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4: pages damaged in several ways, and what is wrong with each."""
    key = F.col("c_custkey")
    sold = F.struct(
        key.cast("int").alias("store_id"), F.col("c_acctbal").alias("sales")
    )
    whole = F.to_json(F.struct(key.alias("page"), F.array(sold).alias("data")))
    body = (
        F.when(key % 7 == 0, "{bad")
        .when(key % 7 == 1, None)
        .when(key % 7 == 2, '{"page": 1, "data": []}')
        .when(key % 7 == 3, "[]")
        .when(key % 7 == 4, F.concat(F.lit('{"page": '), key.cast("string"), F.lit("}")))
        .when(key % 7 == 5, F.replace(whole, F.lit('"sales":'), F.lit('"sales":"x","y":')))
        .otherwise(whole)
    )
    pages = table(spark, sf_dir, "customer").select(key.alias("page"), body.alias("sales_data"))
    return bad_pages(pages)


def raw_land_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales written as one hour of the raw zone and read as its day."""
    root = scratch_path(spark, "raw")
    window = HourWindow(datetime(2024, 1, 31, 3, tzinfo=timezone.utc))
    land_raw(sales(spark, sf_dir), root, window)
    return naive(read_raw_day(spark, root, window.day))


def _ingested(spark: SparkSession, sf_dir: str) -> str:
    """All events as page bodies, brought in by jobs of two hours on each of two days."""
    root = scratch_path(spark, "raw")
    record = F.struct("store_id", "purchase_id", "scale", "store_name", "time", "sales")
    rows = sales(spark, sf_dir).select(
        F.pmod(F.col("purchase_id").cast("bigint"), F.lit(len(WINDOWS))).alias("window"),
        "page",
        record.alias("record"),
    )
    packed = rows.groupBy("window", "page").agg(F.collect_list("record").alias("data"))
    body = F.to_json(F.struct("page", "data"), EXACT_TIMES)
    bodies = materialize(packed.select("window", "page", body.alias("sales_data")), "bodies")
    for i, window in enumerate(WINDOWS):
        fetched = bodies.where(F.col("window") == i).drop("window")
        land_raw(stamp(parse_pages(fetched), window), root, window)
    return root


def ingest_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hour of every day, read back day by day"""
    root = _ingested(spark, sf_dir)
    days = [read_raw_day(spark, root, day) for day in DAYS]
    return naive(days[0].unionByName(days[1]))


def mart_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 K3 K8 K9 Q3: the daily job on what the hourly one left, read through its table.

    ``rows_before`` is what the table shows of a day before its partitions are added.
    """
    raw = _ingested(spark, sf_dir)
    rates_root, mart_root = scratch_path(spark, "rates"), scratch_path(spark, "mart")
    highest = rates(spark, sf_dir).groupBy("currency").agg(F.max("rates").alias("rates"))
    dated = [highest.withColumn("retrieval_date", F.lit(day)) for day in DAYS]
    land_rates(dated[0].unionByName(dated[1]), rates_root)
    database = f"money_{uuid.uuid4().hex}"
    name = f"{database}.salesdata"
    create_table(spark, name, MART, MART_PARTITIONS, mart_root)
    before = {}
    for day in DAYS:
        before[day] = spark.table(name).where(F.col("retrieval_date") == day).count()
        mart_day(spark, raw, rates_root, mart_root, day, table=name)
    seen = F.create_map(*[F.lit(x) for day in DAYS for x in (day, before[day])])
    shown = spark.table(name).withColumn("rows_before", seen[F.col("retrieval_date")])
    # the files outlast the table
    shown = materialize(shown, "mart-days")
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return naive(shown)


# -- rates -------------------------------------------------------------------


def rates_map_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The currency map of each snapshot as rows."""
    return rates_from_documents(rate_documents(spark, sf_dir))


def rates_land_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, through the rates zone."""
    root = scratch_path(spark, "currency_rates")
    land_rates(rates_map_explode(spark, sf_dir), root)
    return read_rates(spark, root)


def _damaged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshots, by day of the month: whole, cut, undated, with one rate unreadable."""
    whole = F.col("value")
    day = F.dayofmonth(F.timestamp_seconds(F.get_json_object(whole, "$.timestamp").cast("bigint")))
    damaged = (
        F.when(day % 4 == 1, F.replace(whole, F.lit('"EUR":0.9375'), F.lit('"EUR":"n/a"')))
        .when(day % 4 == 2, F.regexp_replace(whole, '"timestamp":[0-9]+', '"timestamp":null'))
        .when(day % 4 == 3, F.lit("{bad"))
        .otherwise(whole)
    )
    return rate_documents(spark, sf_dir).select(damaged.alias("value"))


def bad_rate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with damaged snapshots"""
    return bad_documents(_damaged_documents(spark, sf_dir)).groupBy("currency", "reason").agg(
        F.count(F.lit(1)).alias("found")
    )


def rates_partly_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A damaged rate takes no other with it"""
    return rates_from_documents(_damaged_documents(spark, sf_dir))


# -- mart --------------------------------------------------------------------


def sales_rate_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 P5 P11"""
    return naive(join_rates(sales(spark, sf_dir), rates(spark, sf_dir)))


def sales_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2"""
    return naive(unmatched_sales(sales(spark, sf_dir), rates(spark, sf_dir)))


def sales_jpy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10 F9"""
    priced = join_rates(sales(spark, sf_dir), rates(spark, sf_dir))
    return convert_to_yen(priced).select("purchase_id", "scale", "sales", "rates", "sales_jpy")


def jst_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 F6 F7 F8"""
    require_utc(spark)
    split = split_local_time(sales(spark, sf_dir)).withColumn("time_jst", local_time(F.col("time")))
    return naive(
        split.select("purchase_id", "time_jst", "ymd", "hh", F.col("store_id").cast("string"))
    )


def mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_mart(sales(spark, sf_dir), rates(spark, sf_dir))


def sales_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: raw sales and rates to the mart."""
    return naive(mart(spark, sf_dir))


def _stored_mart(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    root = scratch_path(spark, "salesdata")
    write_mart_days(mart(spark, sf_dir), root)
    return root, read_mart(spark, root)


def mart_write_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 T9 T10"""
    return naive(_stored_mart(spark, sf_dir)[1])


def mart_day_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: all sales as one day's mart, written again with fewer stores by a session whose
    overwrites are dynamic; the stores that are gone have to go."""
    root, day = scratch_path(spark, "salesdata"), DAYS[0]
    rows = mart(spark, sf_dir).withColumn("retrieval_date", F.lit(day))
    write_mart(rows, root, day)
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        write_mart(rows.where(F.col("store_name") < "Store K"), root, day)
    finally:
        spark.conf.set(mode, before)
    return naive(read_mart(spark, root, day))


def mart_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6"""
    return partitions_of(mart(spark, sf_dir), MART_PARTITIONS)


def partition_registration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4 K5 K7: the partitions the catalog shows after registration."""
    root, stored = _stored_mart(spark, sf_dir)
    database = f"money_{uuid.uuid4().hex}"
    name = f"{database}.salesdata"
    create_table(spark, name, MART, MART_PARTITIONS, root)
    missing = missing_partitions(
        partitions_of(stored, MART_PARTITIONS), name, MART_PARTITIONS
    )
    register_partitions(missing, name, MART_PARTITIONS)
    shown = registered_partitions(spark, name, MART_PARTITIONS)
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return shown


def _exact(df: DataFrame) -> DataFrame:
    """Decimal yen: sums no longer depend on the order of the rows."""
    return df.withColumn("sales_jpy", F.col("sales_jpy").cast("decimal(18,4)"))


def _as_double(df: DataFrame) -> DataFrame:
    return naive(df.withColumn("売り上げ", F.col("売り上げ").cast("double")))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 P12"""
    return _as_double(sales_hourly(_exact(mart(spark, sf_dir))))


def hourly_with_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 with its day shown"""
    return _as_double(sales_hourly(_exact(mart(spark, sf_dir)), with_ymd=True))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 P12"""
    return _as_double(sales_daily(_exact(mart(spark, sf_dir))))


def stored_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 over the stored mart"""
    return _as_double(sales_daily(_exact(_stored_mart(spark, sf_dir)[1])))


def stored_daily_of_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roll-up of each retrieval date of the stored mart

    The first date is asked for by itself, which reads its partitions alone; all others
    come from one grouped scan, so the plan does not grow with the dates.
    """
    stored = _exact(_stored_mart(spark, sf_dir)[1])
    first = stored.agg(F.min("retrieval_date")).first()[0]
    alone = sales_daily(stored, first).withColumn("day", F.lit(first))
    others = sales_daily_by_date(stored.where(F.col("retrieval_date") > F.lit(first)))
    return _as_double(alone.unionByName(others.withColumnRenamed("retrieval_date", "day")))


# -- quality -----------------------------------------------------------------


def counted_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few very hot keys, and nulls"""
    key = F.when(F.col("event_type") != "error", F.col("event_type"))
    events = table(spark, sf_dir, "events").select("event_id", key.alias("event_type"))
    return key_counts(events, "event_type")


def repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 A3 A4"""
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def scale_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units counted as yen"""
    return unknown_scales(sales(spark, sf_dir))


# -- versioned table ---------------------------------------------------------

ORDER = (COMMIT, "ts", "event_id")


def _versions(log: DataFrame) -> DataFrame:
    return naive(live_rows(log, "user_id", ORDER))


def vt_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5 W2"""
    return _versions(changes(spark, sf_dir))


def vt_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V7"""
    return _versions(changes(spark, sf_dir).where(F.col(COMMIT) <= AS_OF))


def vt_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6"""
    commit = F.col(COMMIT)
    return _versions(changes(spark, sf_dir).where((commit > BEGIN) & (commit <= END)))


def vt_evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The commits up to an instant lack a column"""
    log = changes(spark, sf_dir)
    late = log.where(F.col(COMMIT) > AS_OF)
    early = log.where(F.col(COMMIT) <= AS_OF).drop("value")
    return _versions(late.unionByName(early, allowMissingColumns=True))


def _committed(spark: SparkSession, sf_dir: str, compacted: bool = False) -> VersionedTable:
    """All events through real commits: create, wider upsert, upsert, delete."""
    day = F.date_format("ts", "yyyy-MM-dd").alias("day")
    events = table(spark, sf_dir, "events").select(
        "user_id", "event_type", "event_id", day, "value"
    )
    first = events.where(F.col("day") <= "2024-01-10").drop("value")
    second = events.where(F.col("day").between("2024-01-11", "2024-01-20"))
    third = events.where((F.col("day") > "2024-01-20") | F.col("day").isNull())
    gone = third.where((F.col("event_type") == "error") & (F.col("value") > 30))
    root = scratch_path(spark, "users")
    people = VersionedTable.create(
        first, root, "user_id", "day", "event_id", "20240110000000000"
    )
    people.upsert(second, "20240120000000000")
    if compacted:
        people.compact()
    people.upsert(third, "20240130000000000")
    people.delete(gone, "20240131000000000")
    return people


def vt_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1 V2 V3 V4 V5 V8: snapshot after the commits"""
    return _committed(spark, sf_dir).snapshot()


def vt_table_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V7 V9: the state before the last commits, read after them"""
    return _committed(spark, sf_dir).as_of("20240125000000000")


def vt_table_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6: the rows of the second commit"""
    people = _committed(spark, sf_dir)
    return people.incremental("20240110000000000", "20240120000000000")


def vt_table_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5 from a compacted state and the commits after it"""
    people = _committed(spark, sf_dir, compacted=True)
    return people.snapshot()


# -- geo ---------------------------------------------------------------------


def latlon_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F15"""
    return parse_latlon(points(spark, sf_dir).select("c_custkey", "latlon"))


def point_in_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The smallest box around each point"""
    return locate(
        points(spark, sf_dir).select("c_custkey", "lat", "lon"),
        places(spark, sf_dir),
        tie="n_nationkey",
        payload=["n_nationkey", "n_name"],
    )


def boxes_around(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every box around each point"""
    return containing_boxes(
        points(spark, sf_dir).select("c_custkey", "lat", "lon"),
        places(spark, sf_dir),
        payload=["n_nationkey"],
    )


def enriched_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 G2 X2"""
    asked = enrich_points(points(spark, sf_dir).select("c_custkey", "latlon"), geo_client)
    parsed = asked.transform(parse_response).transform(response_box)
    return parsed.select(
        "c_custkey",
        "latlon",
        "status",
        "malformed",
        F.col("place.place_id").alias("place_id"),
        F.col("place.name").alias("name"),
        "south",
        "north",
        "west",
        "east",
    )


QUERIES = {
    "page_range": page_range,
    "fetched_pages": fetched_pages,
    "json_pages_explode": json_pages_explode,
    "malformed_pages": malformed_pages,
    "raw_land_read": raw_land_read,
    "ingest_hours": ingest_hours,
    "mart_days": mart_days,
    "rates_map_explode": rates_map_explode,
    "rates_land_read": rates_land_read,
    "bad_rate_documents": bad_rate_documents,
    "rates_partly_damaged": rates_partly_damaged,
    "sales_rate_join": sales_rate_join,
    "sales_unmatched": sales_unmatched,
    "sales_jpy": sales_jpy,
    "jst_split": jst_split,
    "sales_mart": sales_mart,
    "mart_write_read": mart_write_read,
    "mart_day_rewrite": mart_day_rewrite,
    "mart_partitions": mart_partitions,
    "partition_registration": partition_registration,
    "sales_hourly": hourly,
    "sales_hourly_with_day": hourly_with_day,
    "sales_daily": daily,
    "stored_sales_daily": stored_daily,
    "stored_sales_daily_of_days": stored_daily_of_days,
    "key_counts": counted_keys,
    "duplicate_keys": repeated_keys,
    "unknown_scales": scale_report,
    "vt_snapshot": vt_snapshot,
    "vt_as_of": vt_as_of,
    "vt_incremental": vt_incremental,
    "vt_evolved": vt_evolved,
    "vt_table": vt_table,
    "vt_table_as_of": vt_table_as_of,
    "vt_table_incremental": vt_table_incremental,
    "vt_table_compacted": vt_table_compacted,
    "latlon_parse": latlon_parse,
    "point_in_box": point_in_box,
    "boxes_around": boxes_around,
    "enrich_points": enriched_points,
}
