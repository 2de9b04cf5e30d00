"""Queries over changes of versioned tables, roll-ups kept by them, and outside services.

Each has its SQL beside it; ``oracles.py`` states the views that they share.
"""

from __future__ import annotations

import uuid
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.catalogue.oracles import (
    EARLY,
    EVERY,
    ORACLES as PLAIN,
    POINTS,
    RATES,
    SALES,
    SNAPSHOT,
)
from martkit.catalogue.queries import _committed
from martkit.catalogue.views import (
    geo_client,
    naive,
    page_client,
    places,
    points,
    rate_documents,
    table,
)
from martkit.operators.changes import flat
from martkit.operators.geo import enrich_points, locate, parse_response, response_box
from martkit.operators.maintained import MaintainedRollup
from martkit.operators.quality import DuplicateKeys, assert_unique
from martkit.operators.versioned import ConcurrentCommit, VersionedTable
from martkit.plans.jobs import load_rates
from martkit.schemas import RATES as RATES_SCHEMA
from martkit.schemas import RATES_PARTITIONS
from martkit.session import materialize, scratch_path
from martkit.sinks.catalog import create_table, register_partition
from martkit.sources.pages import parse_pages
from martkit.sources.paged import fetch_kept, paged_source
from martkit.sources.polite import RateLimit, Retry

# Waits of calls that are tried again; the stand-ins for services recover at once.
QUICK = Retry(attempts=3, first=0.001)

COMMITS = ["20240110000000000", "20240120000000000", "20240130000000000"]


# -- changes -------------------------------------------------------------------


def vt_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6: how the rows of the second commit became those of the last, deleted ones too"""
    return flat(_committed(spark, sf_dir, compacted=True).changes(COMMITS[1]))


_STATE = """SELECT user_id, event_type, event_id, day,
    CASE WHEN _commit_time > '20240110000000000' THEN value END AS value
  FROM written WHERE place = 1"""
_NAMES = ("user_id", "event_type", "event_id", "day", "value")

VT_CHANGES = f"""WITH older AS (WITH {EARLY} {_STATE}),
newer AS (WITH {EVERY} {_STATE} AND user_id NOT IN (SELECT user_id FROM gone))
SELECT CASE WHEN o.user_id IS NULL THEN 'insert' WHEN n.user_id IS NULL THEN 'delete'
    ELSE 'update' END AS change_type, coalesce(o.user_id, n.user_id) AS user_id,
  {', '.join(f'o.{c} AS before_{c}, n.{c} AS after_{c}' for c in _NAMES)}
FROM older o FULL JOIN newer n ON o.user_id = n.user_id
WHERE {' OR '.join(f'o.{c} IS DISTINCT FROM n.{c}' for c in _NAMES)}"""


def maintained_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 A2 V6: a roll-up begun at the first commit and kept up by the changes of the others"""
    people = _committed(spark, sf_dir)
    days = people.as_of(COMMITS[0]).withColumn("value", F.lit(None).cast("double"))
    rollup = MaintainedRollup(spark, scratch_path(spark, "rollup"), ["day", "event_type"], "value")
    rollup.start(days, COMMITS[0])
    for begin, end in zip(COMMITS, COMMITS[1:]):
        rollup.apply(people.changes(begin, end), begin, end)
    rollup.follow(people)
    return rollup.read().withColumn("total", F.col("total").cast("double"))


MAINTAINED_DAILY = f"""SELECT day, event_type, count(*) AS rows,
  CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total
FROM ({SNAPSHOT}) GROUP BY day, event_type"""


def vt_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3: numbers whose types grow from one commit to the next; all states of the table"""
    day = F.date_format("ts", "yyyy-MM-dd").alias("day")
    number = F.col("event_id")
    events = table(spark, sf_dir, "events").select("user_id", "event_id", day)
    kinds = [
        ("int", "decimal(6,2)", number % 1000),
        ("bigint", "decimal(14,4)", number * 1000),
        ("int", "decimal(8,0)", number % 1000),
    ]
    made, states = None, []
    bounds = [("", "2024-01-10"), ("2024-01-10", "2024-01-20"), ("2024-01-20", "9")]
    for commit, (low, high), (whole, exact, value) in zip(COMMITS, bounds, kinds):
        part = events.where((F.col("day") > low) & (F.col("day") <= high)).select(
            "user_id",
            "day",
            "event_id",
            (value * (1_000_000 if whole == "bigint" else 1)).cast(whole).alias("n"),
            value.cast(exact).alias("m"),
        )
        if made is None:
            root = scratch_path(spark, "widened")
            made = VersionedTable.create(part, root, "user_id", "day", "event_id", commit)
        else:
            made.upsert(part, commit)
    for commit in COMMITS:
        rows = made.as_of(commit).select("user_id", "n", "m")
        kind = f"{dict(rows.dtypes)['n']} {dict(rows.dtypes)['m']}"
        rows = rows.select("user_id", F.col("n").cast("bigint"), F.col("m").cast("double"))
        states.append(rows.withColumns({"instant": F.lit(commit), "types": F.lit(kind)}))
    return states[0].union(states[1]).union(states[2])


VT_WIDENED = f"""WITH events_by AS (
  SELECT user_id, event_id, strftime(ts, '%Y-%m-%d') AS day,
    CASE WHEN day <= '2024-01-10' THEN '{COMMITS[0]}' WHEN day <= '2024-01-20' THEN '{COMMITS[1]}'
      ELSE '{COMMITS[2]}' END AS commit_time
  FROM events
), instants(instant, types) AS (VALUES
  ('{COMMITS[0]}', 'int decimal(6,2)'), ('{COMMITS[1]}', 'bigint decimal(14,4)'),
  ('{COMMITS[2]}', 'bigint decimal(14,4)')
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY instant, user_id
    ORDER BY commit_time DESC, event_id DESC) AS place
  FROM events_by JOIN instants ON commit_time <= instant)
SELECT user_id, instant, types,
  CASE WHEN commit_time = '{COMMITS[1]}' THEN event_id * 1000000000 ELSE event_id % 1000 END AS n,
  CAST(CASE WHEN commit_time = '{COMMITS[1]}' THEN event_id * 1000 ELSE event_id % 1000 END
    AS DOUBLE) AS m
FROM ranked WHERE place = 1"""


def vt_two_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2: of two commits made from one state the later is refused; it is in after it starts again"""
    people = _committed(spark, sf_dir)
    other = VersionedTable(spark, people.root)
    state = people.commits()[-1].commit_time
    rows = people.snapshot()
    even = rows.where("user_id % 2 = 0").withColumn("event_type", F.lit("even"))
    third = rows.where("user_id % 3 = 0").withColumn("event_type", F.lit("third"))
    people.upsert(even, "20240201000000000", expected=state)
    try:
        other.upsert(third, "20240202000000000", expected=state)
        refused = 0
    except ConcurrentCommit:
        refused = 1
    state = other.commits()[-1].commit_time
    other.upsert(third, "20240203000000000", expected=state)
    return other.snapshot().withColumn("refused", F.lit(refused))


VT_TWO_WRITERS = f"""SELECT * REPLACE (
    CASE WHEN user_id % 3 = 0 THEN 'third' WHEN user_id % 2 = 0 THEN 'even' ELSE event_type END
      AS event_type,
    CASE WHEN user_id % 3 = 0 THEN '20240203000000000'
      WHEN user_id % 2 = 0 THEN '20240201000000000' ELSE _commit_time END AS _commit_time),
  CAST(1 AS INTEGER) AS refused
FROM ({SNAPSHOT})"""


# -- rates and gates -------------------------------------------------------------


def rates_files_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot files loaded by the job, their days registered one by one"""
    folder, root = scratch_path(spark, "rate-files"), scratch_path(spark, "currency_rates")
    documents = rate_documents(spark, sf_dir)
    # one document a file, as they are landed
    documents.repartition(64, "value").write.option("maxRecordsPerFile", 1).text(folder)
    load_rates(spark, folder, root)
    database = f"master_{uuid.uuid4().hex}"
    name = f"{database}.currency_rates"
    create_table(spark, name, RATES_SCHEMA, RATES_PARTITIONS, root)
    stored = spark.read.parquet(root)
    # one row per calendar day
    for row in stored.select("retrieval_date").distinct().toLocalIterator():
        register_partition(spark, name, row.asDict())
    shown = materialize(spark.table(name), "rates-table")
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return shown


def refused_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3 L1: all keys for which the uniqueness gate refuses, with their counts"""
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey")
    try:
        assert_unique(lines, ["l_partkey", "l_suppkey"])
    except DuplicateKeys as refused:
        return refused.keys
    raise AssertionError("the keys were taken for unique")


REFUSED_KEYS = """SELECT l_partkey, l_suppkey, count(*) AS count FROM lineitem
GROUP BY l_partkey, l_suppkey HAVING count(*) > 1"""


# -- outside services ------------------------------------------------------------


def _failing_pages(known: int):
    """Pages whose first try fails every fifth time; those up to ``known`` may not be asked for."""

    def connect(secret):
        client, tried = page_client(secret), Counter()

        def body(page: int) -> str:
            tried[page] += 1
            if page <= known or (page % 5 == 0 and tried[page] == 1):
                raise OSError(f"page {page}")
            return client(page)

        return body

    return connect


def paged_source_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages read through a source, in two runs of which the second asks for the rest

    A client that fails at first is asked again; pages of the first run fail if asked for.
    """
    total = table(spark, sf_dir, "customer").agg(F.max("c_custkey")).first()[0] + 1
    kept = scratch_path(spark, "kept-pages")
    for upto, known in ((total // 2, 0), (total, total // 2)):
        name = f"sales_pages_{uuid.uuid4().hex}"
        source = paged_source(name, _failing_pages(known), "Store API", QUICK)
        spark.dataSource.register(source)
        pages = fetch_kept(spark, name, upto, kept, on_error="raise")
    return naive(parse_pages(pages))


def _busy_geo_client():
    """The geocoder, too busy at the first try of every third point."""
    client, tried = geo_client(), Counter()

    def answer(latlon: str) -> tuple[int, str]:
        tried[latlon] += 1
        if sum(latlon.encode()) % 3 == 0 and tried[latlon] == 1:
            return 429, "busy"
        return client(latlon)

    return answer


def enrich_points_politely(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers that tell to come again are asked again, at a bounded rate; others not"""
    asked = enrich_points(
        points(spark, sf_dir).select("c_custkey", "latlon"),
        _busy_geo_client,
        retry=QUICK,
        limit=RateLimit(100_000, burst=100),
    )
    parsed = asked.transform(parse_response).transform(response_box)
    place = [F.col(f"place.{c}").alias(c) for c in ("place_id", "name")]
    own = ["c_custkey", "latlon", "status", "malformed"]
    return parsed.select(*own, *place, "south", "north", "west", "east")


def date_line_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The smallest box around each point, where some lie across the date line"""
    shifted = F.pmod(F.col("west") + 330, F.lit(360.0)) - 180
    turned = places(spark, sf_dir).withColumns(
        {"width": F.col("east") - F.col("west"), "west": shifted}
    )
    east = F.col("west") + F.col("width")
    turned = turned.withColumn("east", F.when(east > 180, east - 360).otherwise(east)).drop("width")
    located = points(spark, sf_dir).select("c_custkey", "lat", "lon")
    return locate(located, turned, "n_nationkey", ["n_nationkey", "n_name"], date_line=True)


DATE_LINE_BOXES = f"""WITH {POINTS}, turned AS (
  SELECT n_nationkey, n_name, south, south + 40 AS north, west, width,
    CASE WHEN west + width > 180 THEN west + width - 360 ELSE west + width END AS east
  FROM (
    SELECT n_nationkey, n_name, CAST(-90 + (n_nationkey % 5) * 36 AS DOUBLE) AS south,
      CAST((-180 + (n_nationkey // 5) * 72 + 330 + 360) % 360 - 180 AS DOUBLE) AS west,
      72 + 8 * (n_nationkey % 3) AS width
    FROM nation)
), ranked AS (
  SELECT c_custkey, lat, lon, n_nationkey, n_name, row_number() OVER (
    PARTITION BY c_custkey ORDER BY 40 * width, n_nationkey) AS place
  FROM points LEFT JOIN turned ON lat BETWEEN south AND north
    AND CASE WHEN west <= east THEN lon BETWEEN west AND east ELSE lon >= west OR lon <= east END)
SELECT c_custkey, lat, lon, n_nationkey, n_name FROM ranked WHERE place = 1"""


QUERIES = {
    "vt_changes": vt_changes,
    "maintained_daily": maintained_daily,
    "vt_widened": vt_widened,
    "vt_two_writers": vt_two_writers,
    "rates_files_table": rates_files_table,
    "refused_keys": refused_keys,
    "paged_source_kept": paged_source_kept,
    "enrich_points_politely": enrich_points_politely,
    "date_line_boxes": date_line_boxes,
}

ORACLES = {
    "vt_changes": VT_CHANGES,
    "maintained_daily": MAINTAINED_DAILY,
    "vt_widened": VT_WIDENED,
    "vt_two_writers": VT_TWO_WRITERS,
    "rates_files_table": f"WITH {SALES}, {RATES} SELECT * FROM rates",
    "refused_keys": REFUSED_KEYS,
    "paged_source_kept": PLAIN["fetched_pages"],
    "enrich_points_politely": PLAIN["enrich_points"],
    "date_line_boxes": DATE_LINE_BOXES,
}
