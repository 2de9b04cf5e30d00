from datetime import datetime, timezone

import pytest
from fixtures import connect, page_body
from plans import tree

from martkit.functions.times import HourWindow
from martkit.plans.jobs import ingest_hour
from martkit.sinks.zones import EmptyOverwrite, PartialOverwrite
from martkit.sources.pages import (
    bad_pages,
    fetch_pages,
    page_count,
    page_frame,
    parse_pages,
    stamp,
)
from martkit.sources.zones import read_raw_day

WINDOW = HourWindow(datetime(2024, 6, 12, 19, tzinfo=timezone.utc))


def test_s1_page_frame(spark):
    pages = page_frame(spark, 10, parallelism=3)
    assert sorted(row.page for row in pages.collect()) == list(range(1, 11))
    assert pages.rdd.getNumPartitions() == 3
    assert page_count(page_body) == 10


def test_f1_pages_become_sales(spark):
    sales = parse_pages(fetch_pages(page_frame(spark, 10), connect))
    assert sales.columns == [
        "page", "store_id", "purchase_id", "scale", "store_name", "time", "sales",
    ]
    rows = {(row.page, row.purchase_id): row for row in sales.collect()}
    assert len(rows) == 40
    row = rows[(2, "A0022")]
    assert (row.store_id, row.scale, row.store_name, row.sales) == (1, "yen", "Store A", 8000.0)
    assert row.time == datetime(2024, 6, 12, 19, 45, 30, 456000)
    assert dict(sales.dtypes)["sales"] == "double"


def test_s3_every_task_connects_once_with_the_secret(spark):
    def connect_with(secret):
        return lambda page: f"{secret}-{page}"

    bodies = fetch_pages(page_frame(spark, 40, 2), connect_with, secret="s").collect()
    assert {row.sales_data for row in bodies} == {f"s-{page}" for page in range(1, 41)}


def failing(secret):
    def body(page):
        if page == 3:
            raise OSError("no answer")
        return page_body(page)

    return body


def test_t14_failing_page(spark):
    pages = page_frame(spark, 4)
    fetched = fetch_pages(pages, failing, on_error="empty")
    assert parse_pages(fetched).count() == 12
    assert [tuple(row) for row in bad_pages(fetched).collect()] == [(3, "failed")]
    errors = fetched.where("error is not null").collect()
    assert [(r["page"], r["sales_data"]) for r in errors] == [(3, None)]
    assert "no answer" in errors[0]["error"]
    with pytest.raises(Exception, match="no answer"):
        fetch_pages(pages, failing).collect()
    with pytest.raises(ValueError):
        fetch_pages(pages, failing, on_error="skip")


def test_t14_damaged_pages(spark):
    bodies = [
        (1, "[]"),
        (2, "{bad"),
        (3, None),
        (4, '{"page":4,"data":[]}'),
        (5, '{"page":5}'),
        (6, '{"page":6,"data":[{"store_id":1,"sales":"x","time":"nope"}]}'),
        (7, page_body(7)),
    ]
    fetched = spark.createDataFrame(bodies, "page long, sales_data string")
    rows = parse_pages(fetched).collect()
    assert [row.page for row in rows] == [6, 7, 7, 7, 7]
    assert (rows[0].store_id, rows[0].sales, rows[0].time) == (1, None, None)
    reasons = {row.page: row.reason for row in bad_pages(fetched).collect()}
    assert reasons == {
        1: "unparsable", 2: "unparsable", 3: "missing", 4: "empty", 5: "no data", 6: "bad field",
    }


def test_t16_one_fetch_per_page(spark):
    fetched = parse_pages(fetch_pages(page_frame(spark, 10), connect))
    assert tree(fetched).count("MapInPandas") == 1
    assert "BatchEvalPython" not in tree(fetched)
    # nor is a body parsed twice; the parser reads the records only
    assert tree(fetched).count("from_json") == 1
    assert "total_pages" not in tree(fetched)
    report = bad_pages(fetch_pages(page_frame(spark, 10), connect))
    assert tree(report).count("from_json") == 1


def test_null_record_is_kept(spark):
    fetched = spark.createDataFrame([(1, '{"data":[null,{"store_id":1}]}')], "page long, sales_data string")
    assert [row.store_id for row in parse_pages(fetched).collect()] == [None, 1]


def test_t1_stamp_and_path_follow_the_window(spark, tmp_path):
    late = HourWindow(datetime(2024, 6, 13, 14, tzinfo=timezone.utc))
    root = str(tmp_path / "raw")
    ingest_hour(spark, connect, 10, late, root)
    assert (tmp_path / "raw" / "2024-06-13" / "23").is_dir()
    day = read_raw_day(spark, root, "2024-06-13")
    assert day.count() == 40
    assert {row.retrieval_date for row in day.collect()} == {"2024-06-13"}


def test_ingest_hour_can_run_again(spark, tmp_path):
    root = str(tmp_path / "raw")
    for _ in range(2):
        report = ingest_hour(
            spark, failing, 10, WINDOW, root, files=2, on_error="empty", allow_partial=True
        )
        assert [tuple(row) for row in report.collect()] == [(3, "failed")]
    assert read_raw_day(spark, root, "2024-06-13").count() == 36
    assert len(list((tmp_path / "raw" / "2024-06-13" / "04").glob("*.parquet"))) == 2


def test_an_outage_keeps_the_hour(spark, tmp_path):
    root = str(tmp_path / "raw")
    ingest_hour(spark, connect, 10, WINDOW, root)
    with pytest.raises(PartialOverwrite, match="1 of 10 pages"):
        ingest_hour(spark, failing, 10, WINDOW, root, on_error="empty")
    with pytest.raises(EmptyOverwrite):
        ingest_hour(spark, lambda secret: lambda page: "[]", 10, WINDOW, root)
    assert read_raw_day(spark, root, "2024-06-13").count() == 40
    ingest_hour(spark, lambda secret: lambda page: "[]", 10, WINDOW, root, allow_empty=True)
    assert read_raw_day(spark, root, "2024-06-13").count() == 0


def test_raw_columns(spark):
    stamped = stamp(parse_pages(fetch_pages(page_frame(spark, 1), connect)), WINDOW)
    assert stamped.dtypes[0] == ("page", "bigint")
    assert stamped.dtypes[-1] == ("retrieval_date", "string")
