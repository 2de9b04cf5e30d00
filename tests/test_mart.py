from datetime import datetime, timezone

import pytest
from fixtures import DAY, RATES_DOCUMENT, connect
from plans import plan, tree
from pyspark.sql import functions as F

from martkit.functions.times import HourWindow
from martkit.operators.mart import build_mart, join_rates, split_local_time, unmatched_sales
from martkit.operators.quality import DuplicateKeys, unknown_scales
from martkit.operators.rollup import TOTAL, sales_daily, sales_hourly
from martkit.plans.jobs import ingest_hour, load_rates, mart_day
from martkit.schemas import MART, RAW_SALES
from martkit.sinks.zones import EmptyOverwrite
from martkit.sources.pages import fetch_pages, page_frame, parse_pages, stamp
from martkit.sources.rates import rates_from_documents
from martkit.sources.zones import read_mart, read_rates, read_raw_day

WINDOW = HourWindow(datetime(2024, 6, 12, 19, tzinfo=timezone.utc))


@pytest.fixture(scope="module")
def sales(spark):
    return stamp(parse_pages(fetch_pages(page_frame(spark, 10), connect)), WINDOW)


@pytest.fixture(scope="module")
def rates(spark):
    return rates_from_documents(spark.createDataFrame([(RATES_DOCUMENT,)], "value string"))


def sale(**values):
    row = dict.fromkeys(RAW_SALES.names)
    return tuple({**row, "retrieval_date": DAY, **values}.values())


def test_f4_golden_rows(spark, sales, rates):
    mart = build_mart(sales, rates)
    assert mart.dtypes == [(f.name, f.dataType.simpleString()) for f in MART.fields]
    rows = {row.purchase_id: row for row in mart.collect()}
    assert len(rows) == 40
    dollars = rows["B0012"]
    assert (dollars.page, dollars.store_id, dollars.sales) == (2, "2", 20000.0)
    assert dollars.sales_jpy == 20000 * 156.79364286 == 3135872.8572
    assert rows["B0025"].sales_jpy == pytest.approx(1881523.71432, rel=1e-15)
    assert rows["A0022"].sales_jpy == 8000.0
    assert rows["A0022"].time == datetime(2024, 6, 12, 19, 45, 30, 456000)
    assert {(str(row.ymd), row.hh) for row in rows.values()} == {(DAY, "4")}


def test_f4_rollups_agree(sales, rates):
    mart = build_mart(sales, rates)
    daily = {row.store_id: row[TOTAL] for row in sales_daily(mart, DAY).collect()}
    assert daily == {"1": 230000.0, "2": pytest.approx(50173965.7152, rel=1e-9)}
    hourly = {(row.hh, row.store_id): row[TOTAL] for row in sales_hourly(mart).collect()}
    assert hourly == {("4", store): pytest.approx(total) for store, total in daily.items()}


def test_t3_unknown_units_count_as_yen(spark, rates):
    rows = [
        sale(purchase_id="a", scale="pound", sales=5.0),
        sale(purchase_id="b", scale=None, sales=6.0),
        sale(purchase_id="c", scale="us_doller", sales=None),
        sale(purchase_id="d", scale="yen", sales=1.0),
    ]
    sales = spark.createDataFrame(rows, RAW_SALES)
    found = {row.purchase_id: row.sales_jpy for row in build_mart(sales, rates).collect()}
    assert found == {"a": 5.0, "b": 6.0, "c": None, "d": 1.0}
    assert {tuple(row) for row in unknown_scales(sales).collect()} == {("pound", 1), (None, 1)}


def test_t7_sales_without_a_rate(spark, sales, rates):
    late = sales.withColumn("retrieval_date", F.lit("2024-06-14"))
    assert join_rates(late, rates).count() == 0
    assert unmatched_sales(late.union(sales), rates).count() == 40


def test_t8_a_second_rate_multiplies_the_join(sales, rates):
    assert join_rates(sales, rates.union(rates)).count() == 80


def test_j1_rates_are_broadcast_and_sales_not_shuffled(spark, tmp_path, sales, rates):
    sales.write.parquet(str(tmp_path / "raw"))
    rates.write.partitionBy("retrieval_date").parquet(str(tmp_path / "rates"))
    stored = spark.read.schema(RAW_SALES).parquet(str(tmp_path / "raw"))
    mart = build_mart(stored, read_rates(spark, str(tmp_path / "rates"), DAY))
    text = tree(mart)
    assert text.count("BroadcastHashJoin") == 1
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text
    narrow = plan(mart.groupBy("store_id").agg(F.sum("sales")))
    assert "ReadSchema: struct<store_id:int,sales:double,retrieval_date:string>" in narrow


def test_j1_beyond_the_broadcast_bound(sales, rates, set_conf):
    """A single hot date, joined by salts, gives the same rows."""
    set_conf(spark__sql__autoBroadcastJoinThreshold="-1")
    plain = join_rates(sales, rates)
    salted = join_rates(sales, rates, max_rows=0, hot_rows=4)
    # the date is one constant here, so without the salt all rows would meet in one task
    assert "Exchange hashpartitioning(__salt" in tree(salted)
    assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, plain.collect()))


@pytest.fixture
def zones(spark, tmp_path):
    raw, rates, mart = (str(tmp_path / name) for name in ("raw", "rates", "mart"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "latest.json").write_text(RATES_DOCUMENT)
    ingest_hour(spark, connect, 10, WINDOW, raw)
    load_rates(spark, str(tmp_path / "in"), rates)
    return raw, rates, mart


def test_mart_day(spark, zones):
    report = mart_day(spark, *zones, DAY)
    assert read_mart(spark, zones[2], DAY).count() == 40
    assert report.unmatched.isEmpty() and report.unknown_scales.isEmpty()


def test_t1_midnight_hour_reaches_the_mart(spark, zones):
    def night(secret):
        return lambda page: connect(secret)(page).replace("00", "09").replace("T19", "T14")

    late = HourWindow(datetime(2024, 6, 13, 14, tzinfo=timezone.utc))
    ingest_hour(spark, night, 10, late, zones[0])
    mart_day(spark, *zones, DAY)
    assert read_mart(spark, zones[2], DAY).count() == 80


def test_q3_repeated_purchases_stop_the_write(spark, zones):
    mart_day(spark, *zones, DAY)
    again = HourWindow(datetime(2024, 6, 12, 20, tzinfo=timezone.utc))
    ingest_hour(spark, connect, 10, again, zones[0])
    with pytest.raises(DuplicateKeys, match="purchase_id"):
        mart_day(spark, *zones, DAY)
    assert read_mart(spark, zones[2], DAY).count() == 40
    with pytest.warns(UserWarning, match="non-unique purchase_id"):
        mart_day(spark, *zones, DAY, on_duplicate="warn")
    assert read_mart(spark, zones[2], DAY).count() == 80


def test_t7_missing_rate_keeps_the_stored_mart(spark, zones, tmp_path):
    mart_day(spark, *zones, DAY)
    raw, rates, mart = zones
    with pytest.raises(EmptyOverwrite):
        mart_day(spark, raw, rates, mart, DAY, currency="XXX")
    assert read_mart(spark, mart, DAY).count() == 40
    report = mart_day(spark, raw, rates, mart, DAY, currency="XXX", allow_empty=True)
    assert report.unmatched.count() == 40
    assert read_raw_day(spark, raw, DAY).count() == 40


def test_t2_local_time_needs_utc(spark, sales, set_conf):
    set_conf(spark__sql__session__timeZone="Asia/Tokyo")
    with pytest.raises(ValueError, match="UTC"):
        split_local_time(sales)
