from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from martkit.functions.times import HourWindow
from martkit.schemas import MART, RAW_SALES
from martkit.sinks.zones import EmptyOverwrite, land_raw, write_mart, write_mart_days
from martkit.sources.zones import read_mart, read_raw_day

DAY = "2024-06-13"
WINDOW = HourWindow(datetime(2024, 6, 12, 19, tzinfo=timezone.utc))


def mart_rows(spark, stores, day=DAY, n=1):
    values = {"page": F.lit(1), "retrieval_date": F.lit(day), "purchase_id": F.col("id").cast("string")}
    frame = spark.range(n).withColumn("store_id", F.explode(F.array(*map(F.lit, stores))))
    return frame.select(
        *[
            values.get(f.name, F.col("store_id") if f.name == "store_id" else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in MART.fields
        ]
    )


def stores(spark, root):
    rows = read_mart(spark, root).select("retrieval_date", "store_id").distinct().collect()
    return sorted(map(tuple, rows))


def test_k1_hour_is_replaced(spark, tmp_path):
    rows = spark.createDataFrame([(i, *[None] * 6, DAY) for i in range(10)], RAW_SALES)
    root = str(tmp_path)
    land_raw(rows, root, WINDOW)
    land_raw(rows.limit(4), root, WINDOW, files=2)
    assert read_raw_day(spark, root, DAY).count() == 4
    files = list((tmp_path / DAY / "04").glob("*.parquet"))
    assert len(files) == 2 and all(".snappy." in file.name for file in files)


def test_k2_static_overwrite_drops_absent_stores(spark, tmp_path):
    root = str(tmp_path)
    write_mart(mart_rows(spark, ["1", "2"]), root, DAY)
    write_mart(mart_rows(spark, ["1"], "2024-06-14"), root, "2024-06-14")
    write_mart(mart_rows(spark, ["2", "3"]), root, DAY)
    assert stores(spark, root) == [(DAY, "2"), (DAY, "3"), ("2024-06-14", "1")]


def test_k2_many_days_keep_absent_stores(spark, tmp_path):
    root = str(tmp_path)
    write_mart_days(mart_rows(spark, ["1", "2"]), root)
    write_mart_days(mart_rows(spark, ["2"]).union(mart_rows(spark, ["1"], "2024-06-14")), root)
    assert stores(spark, root) == [(DAY, "1"), (DAY, "2"), ("2024-06-14", "1")]


def test_t6_t9_files_hold_the_mart_columns_only(spark, tmp_path):
    write_mart(mart_rows(spark, ["1"]), str(tmp_path), DAY)
    [file] = (tmp_path / f"retrieval_date={DAY}" / "store_id=1").glob("*.parquet")
    inside = spark.read.parquet(str(file)).columns
    assert inside == [n for n in MART.names if n not in ("retrieval_date", "store_id")]


def test_t10_partition_values_stay_text(spark, tmp_path):
    write_mart(mart_rows(spark, ["01"]), str(tmp_path), DAY)
    inferred = dict(spark.read.parquet(str(tmp_path)).dtypes)
    assert inferred["retrieval_date"] == inferred["store_id"] == "string"
    assert stores(spark, str(tmp_path)) == [(DAY, "01")]


def test_t7_empty_overwrite(spark, tmp_path):
    root = str(tmp_path)
    write_mart(mart_rows(spark, ["1"]), root, DAY)
    empty = mart_rows(spark, ["1"], n=0)
    with pytest.raises(EmptyOverwrite):
        write_mart(empty, root, DAY)
    assert stores(spark, root) == [(DAY, "1")]
    write_mart(empty, root, DAY, allow_empty=True)
    assert stores(spark, root) == []


def test_t11_rows_of_another_day_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="other days"):
        write_mart(mart_rows(spark, ["1"], "2024-06-14"), str(tmp_path), DAY)


def test_hot_store_is_split_over_files(spark, tmp_path, set_conf):
    """A store larger than the advisory size does not pass through one task."""
    set_conf(
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64k",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="64k",
    )
    hot = mart_rows(spark, ["1"], n=200_000).repartition(8)
    write_mart(hot.union(mart_rows(spark, ["2"], n=10)), str(tmp_path), DAY)
    day = tmp_path / f"retrieval_date={DAY}"
    assert len(list((day / "store_id=1").glob("*.parquet"))) > 2
    assert read_mart(spark, str(tmp_path), DAY).count() == 200_010


def test_rows_can_be_sorted_by_time(spark, tmp_path):
    rows = mart_rows(spark, ["1"], n=100).withColumn(
        "time", F.timestamp_seconds(F.col("purchase_id").cast("int") * 7919 % 100)
    )
    write_mart(rows, str(tmp_path), DAY, sort_by_time=True)
    times = [row.time for row in read_mart(spark, str(tmp_path)).collect()]
    assert times == sorted(times)
