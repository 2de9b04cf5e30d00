from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from martkit.functions.times import HourWindow, local_day, previous_day, previous_hour, snapshot_day

UTC = timezone.utc


def test_f13_previous_hour_and_day():
    window = previous_hour(datetime(2024, 6, 12, 20, 10, tzinfo=UTC))
    assert (window.day, window.hour) == ("2024-06-13", "04")
    assert previous_day(datetime(2024, 6, 13, 16, tzinfo=UTC)) == "2024-06-13"


def test_t1_midnight_run_keeps_the_day_of_its_window():
    # 00:10 local time on the 14th fetches hour 23 of the 13th
    window = previous_hour(datetime(2024, 6, 13, 15, 10, tzinfo=UTC))
    assert (window.day, window.hour) == ("2024-06-13", "23")
    assert window.end == datetime(2024, 6, 13, 15, tzinfo=UTC)


def test_windows_need_a_zone():
    with pytest.raises(ValueError):
        HourWindow(datetime(2024, 6, 13))
    with pytest.raises(ValueError):
        previous_day(datetime(2024, 6, 13))


def test_f12_snapshot_day(spark):
    epochs = spark.createDataFrame([(1718294400,), (1718290799,), (1718290800,)], "t long")
    days = [row[0] for row in epochs.select(snapshot_day(F.col("t"))).collect()]
    # the last two are the second before, and the second of, local midnight
    assert days == ["2024-06-13", "2024-06-12", "2024-06-13"]


def test_f6_local_day(spark):
    frame = spark.sql("SELECT timestamp'2024-06-12T14:59:59.999Z' a, timestamp'2024-06-12T15:00:00Z' b")
    days = frame.select(local_day(F.col("a")).cast("string"), local_day(F.col("b")).cast("string"))
    assert tuple(days.first()) == ("2024-06-12", "2024-06-13")
