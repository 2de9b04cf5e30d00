import re
import uuid
from datetime import datetime, timezone

import pytest
from plans import tree
from pyspark.sql import functions as F

from martkit.functions.times import HourWindow
from martkit.operators.history import filter_bits, key_bitmaps, possibly_in, repeated_across_days
from martkit.operators.quality import DuplicateKeys
from martkit.plans.publish import publish_day, replays
from martkit.schemas import MART, MART_PARTITIONS, RAW_SALES
from martkit.sinks.catalog import (
    create_table,
    partitions_of,
    reconcile_partitions,
    registered_partitions,
    stale_partitions,
)
from martkit.sinks.publish import (
    AuditFailed,
    audit_run,
    publish_run,
    remove_run,
    runs_shown,
    write_run,
)
from martkit.sinks.zones import EmptyOverwrite, land_rates, land_raw, write_mart
from martkit.sources.zones import read_mart

DAYS = ["2024-03-01", "2024-03-02"]


class Zone:
    """Raw, rates and mart folders with a table over the last."""

    def __init__(self, spark, root):
        self.spark = spark
        self.raw, self.rates, self.mart = (f"{root}/{name}" for name in ("raw", "rates", "mart"))
        self.database = f"publish_{uuid.uuid4().hex}"
        self.table = f"{self.database}.salesdata"
        create_table(spark, self.table, MART, MART_PARTITIONS, self.mart)
        rates = [("JPY", 150.0, day) for day in DAYS]
        land_rates(spark.createDataFrame(rates, "currency string, rates double, retrieval_date string"), self.rates)

    def land(self, day, rows):
        """``rows``: (store, purchase id, unit)."""
        instant = datetime.fromisoformat(f"{day}T03:00:00").replace(tzinfo=timezone.utc)
        columns = "store_id int, purchase_id string, scale string"
        sales = self.spark.createDataFrame(rows, columns).select(
            F.lit(1).cast("bigint").alias("page"),
            "store_id",
            "purchase_id",
            "scale",
            F.lit("a shop").alias("store_name"),
            F.lit(instant).cast("timestamp").alias("time"),
            F.lit(2.0).alias("sales"),
            F.lit(day).alias("retrieval_date"),
        )
        land_raw(sales.select(*RAW_SALES.names), self.raw, HourWindow(instant))

    def publish(self, day, **options):
        return publish_day(self.spark, self.raw, self.rates, self.mart, day, self.table, **options)

    def shown(self, day=None):
        rows = self.spark.table(self.table)
        rows = rows if day is None else rows.where(F.col("retrieval_date") == day)
        return sorted((r.retrieval_date, r.store_id, r.purchase_id) for r in rows.collect())

    def listed(self):
        known = registered_partitions(self.spark, self.table, MART_PARTITIONS)
        return sorted((tuple(row) for row in known.collect()), key=str)


@pytest.fixture
def zone(spark, tmp_path):
    made = Zone(spark, str(tmp_path))
    yield made
    spark.sql(f"DROP DATABASE {made.database} CASCADE")


def test_a_day_is_published_again_with_other_stores(spark, zone):
    zone.land(DAYS[0], [(1, "a", "yen"), (2, "b", "us_doller"), (3, "c", None), (3, "d", "pound")])
    report = zone.publish(DAYS[0], run="first")
    assert report.published.added == 3 and report.published.moved == report.published.dropped == 0
    assert report.counted == {
        "rows": 4, "other_days": 0, "sales_read": 4, "unmatched": 0, "unknown_scales": 1,
        "null_scales": 1, "null_ids": 0, "null_times": 0, "null_sales": 0,
    }
    zone.land(DAYS[1], [(1, "z", "yen")])
    zone.publish(DAYS[1])

    zone.land(DAYS[0], [(2, "b", "yen"), (4, "e", "yen")])
    report = zone.publish(DAYS[0], run="second")
    assert (report.published.added, report.published.moved, report.published.dropped) == (1, 1, 2)
    assert zone.shown(DAYS[0]) == [(DAYS[0], "2", "b"), (DAYS[0], "4", "e")]
    assert zone.listed() == [(DAYS[0], "2"), (DAYS[0], "4"), (DAYS[1], "1")]
    assert zone.shown(DAYS[1]) == [(DAYS[1], "1", "z")]

    assert runs_shown(spark, zone.table, DAYS[0]) == ["second"]
    with pytest.raises(ValueError, match="is shown"):
        remove_run(spark, zone.mart, DAYS[0], "second", zone.table)
    remove_run(spark, zone.mart, DAYS[0], "first", zone.table)
    assert len(zone.shown()) == 3
    # runs are hidden from readers of the root
    assert spark.read.schema(MART).parquet(zone.mart).isEmpty()


def test_the_old_day_outlasts_a_failing_write(spark, zone):
    zone.land(DAYS[0], [(1, "a", "yen")])
    zone.publish(DAYS[0])
    fails = F.udf(lambda text: 1 / 0, "string")
    rows = spark.table(zone.table).withColumn("store_name", fails("store_name"))
    rows = rows.select(*MART.names)
    with pytest.raises(Exception, match="ZeroDivision"):
        write_run(rows, zone.mart, DAYS[0])
    assert zone.shown() == [(DAYS[0], "1", "a")]


def test_the_old_day_outlasts_failing_audits(spark, zone):
    zone.land(DAYS[0], [(1, "a", "yen")])
    zone.publish(DAYS[0])
    zone.land(DAYS[1], [(1, "y", "yen")])
    zone.publish(DAYS[1])
    before = zone.shown()

    zone.land(DAYS[0], [(1, "b", "yen"), (2, "b", "yen")])
    with pytest.raises(DuplicateKeys):
        zone.publish(DAYS[0])
    zone.land(DAYS[0], [(1, "y", "yen")])
    with pytest.raises(DuplicateKeys, match="2024-03-02") as raised:
        zone.publish(DAYS[0])
    assert [tuple(r) for r in raised.value.keys.collect()] == [("y", [DAYS[1]])]
    assert zone.shown() == before

    zone.land(DAYS[0], [])
    with pytest.raises(EmptyOverwrite):
        zone.publish(DAYS[0])
    rows = spark.table(zone.table).where(F.col("retrieval_date") == DAYS[1])
    with pytest.raises(AuditFailed, match="other days"):
        audit_run(spark, write_run(rows, zone.mart, DAYS[0]))
    assert zone.shown() == before


def test_a_run_that_lost_rows_is_not_published(spark, zone):
    zone.land(DAYS[0], [(1, "a", "yen"), (2, "b", "yen")])
    zone.publish(DAYS[0])
    rows = spark.table(zone.table).where("store_id = 1").select(*MART.names)
    run = write_run(rows, zone.mart, DAYS[0])
    short = type(run)(run.day, run.name, run.root, {**run.counted, "rows": 5})
    with pytest.raises(AuditFailed, match="1 rows are stored of 5"):
        audit_run(spark, short)
    # a publication that broke off is finished by another
    publish_run(spark, run, zone.table)
    assert publish_run(spark, run, zone.table).moved == 1
    assert zone.shown() == [(DAYS[0], "1", "a")]


def test_warnings_and_bounds(spark, zone):
    zone.land(DAYS[0], [(1, "a", "yen")])
    zone.publish(DAYS[0])
    zone.land(DAYS[1], [(1, "a", "yen")])
    with pytest.warns(UserWarning, match="other days"):
        report = zone.publish(DAYS[1], on_replay="warn")
    assert [r.purchase_id for r in replays(spark, report.run, zone.table).collect()] == ["a"]
    assert replays(spark, report.run, zone.table, since=DAYS[1]).isEmpty()
    zone.publish(DAYS[1], on_replay="ignore")
    with pytest.raises(ValueError, match="on_replay"):
        zone.publish(DAYS[1], on_replay="?")

    zone.land("2024-03-03", [(1, "q", "yen")])
    with pytest.raises(ValueError, match="1 sales of 2024-03-03 have no rate"):
        zone.publish("2024-03-03", max_unmatched=0)
    report = zone.publish("2024-03-03", allow_empty=True)
    assert report.counted["rows"] == 0 and report.counted["unmatched"] == 1


def plans_over(spark, folder, since):
    """Final plans, executed since then, that scan files of the folder."""
    listed = spark._jsparkSession.sharedState().statusStore().executionsList()
    texts = [listed.apply(i).physicalPlanDescription() for i in range(since, listed.size())]
    scan = re.compile(rf"Location: .*{re.escape(folder)}")
    return [t.partition("== Initial Plan ==")[0] for t in texts if scan.search(t)]


def test_the_raw_zone_is_scanned_once(spark, zone):
    zone.land(DAYS[0], [(1, "a", "yen"), (2, "b", "us_doller")])
    before = spark._jsparkSession.sharedState().statusStore().executionsList().size()
    zone.publish(DAYS[0])
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    (one,) = plans_over(spark, f"{zone.raw}/", before)
    # sales and rates, and the writer on top of them
    assert one.count("Scan parquet") == 2 and "CollectMetrics" in one and "WriteFiles" in one


def test_reconciliation_drops_what_is_gone(spark, zone):
    rows = spark.range(3).select(
        *[
            (F.col("id") if f.name == "store_id" else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in MART.fields
        ]
    ).withColumn("retrieval_date", F.lit(DAYS[0]))
    write_mart(rows, zone.mart, DAYS[0])
    stored = partitions_of(read_mart(spark, zone.mart), MART_PARTITIONS)
    done = reconcile_partitions(stored, zone.table, MART_PARTITIONS)
    assert (done.added, done.dropped) == (3, 0)
    write_mart(rows.where("store_id < 2").withColumn("store_id", F.expr("store_id * 5")), zone.mart, DAYS[0])
    stored = partitions_of(read_mart(spark, zone.mart), MART_PARTITIONS)
    gone = stale_partitions(stored, zone.table, MART_PARTITIONS)
    assert sorted(tuple(r) for r in gone.collect()) == [(DAYS[0], "1"), (DAYS[0], "2")]
    done = reconcile_partitions(stored, zone.table, MART_PARTITIONS, {"retrieval_date": DAYS[0]})
    assert (done.added, done.dropped) == (1, 2)
    assert zone.listed() == [(DAYS[0], "0"), (DAYS[0], "5")]
    done = reconcile_partitions(stored, zone.table, MART_PARTITIONS)
    assert (done.added, done.dropped) == (0, 0)

    with pytest.raises(ValueError, match="outside"):
        reconcile_partitions(stored, zone.table, MART_PARTITIONS, {"retrieval_date": DAYS[1]})
    with pytest.raises(ValueError, match="are kept"):
        reconcile_partitions(stored.limit(0), zone.table, MART_PARTITIONS)
    done = reconcile_partitions(stored.limit(0), zone.table, MART_PARTITIONS, allow_empty=True)
    assert (done.added, done.dropped) == (0, 2) and zone.listed() == []


def test_a_null_partition_is_dropped(spark, zone):
    schema = "retrieval_date string, store_id string"
    present = spark.createDataFrame([(DAYS[0], None), (DAYS[0], "a=b/c")], schema)
    reconcile_partitions(present, zone.table, MART_PARTITIONS)
    assert len(zone.listed()) == 2
    done = reconcile_partitions(present.where("store_id is null"), zone.table, MART_PARTITIONS)
    assert (done.added, done.dropped) == (0, 1)
    reconcile_partitions(present.limit(0), zone.table, MART_PARTITIONS, allow_empty=True)
    assert zone.listed() == []


def test_keys_of_thirty_days(spark):
    stored = spark.range(30_000).selectExpr(
        "concat('p', id) as purchase_id", "concat('2024-01-', lpad(id % 30 + 1, 2, '0')) as retrieval_date"
    )
    new = spark.range(29_900, 31_000).selectExpr("concat('p', id) as purchase_id")
    new = new.union(spark.sql("select cast(null as string)"))
    found = {row.purchase_id: row.days for row in repeated_across_days(new, stored).collect()}
    assert found == {f"p{i}": [f"2024-01-{i % 30 + 1:02}"] for i in range(29_900, 30_000)}


def test_stored_days_are_not_shuffled(spark):
    stored = spark.range(5000).selectExpr("concat('p', id) as purchase_id", "'d' as retrieval_date")
    keys = spark.range(100).selectExpr("concat('p', id * 7) as purchase_id")
    bits = filter_bits(100)
    near = possibly_in(stored, key_bitmaps(keys, "purchase_id", bits), "purchase_id", bits)
    hit = {r.purchase_id for r in near.collect()}
    assert {f"p{i * 7}" for i in range(100)} <= hit and len(hit) < 300
    streamed, _, built = tree(near.select("*")).partition("BroadcastExchange")
    # the only shuffle is that of the bitmaps, on the side that is broadcast
    assert "BroadcastHashJoin" in streamed and "Exchange hashpartitioning" not in streamed
    assert built.count("Exchange hashpartitioning") == 1


def test_the_size_of_the_filter_is_bounded():
    assert filter_bits(0) == filter_bits(1) == 15
    assert filter_bits(1 << 20) == 26
    assert filter_bits(1 << 27) == 29
    assert filter_bits((1 << 27) + 1) is None


def test_without_a_filter_the_result_is_the_same(spark, monkeypatch):
    from martkit.operators import history

    monkeypatch.setattr(history, "filter_bits", lambda keys: None)
    stored = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1"), (None, "1")], "purchase_id string, retrieval_date string")
    new = spark.createDataFrame([("a",), ("a",), (None,)], "purchase_id string")
    assert [tuple(r) for r in history.repeated_across_days(new, stored).collect()] == [("a", ["1", "2"])]
