import pytest
from plans import plan, tree
from test_zones import DAY, mart_rows

from martkit.operators.rollup import TOTAL, sales_daily, sales_hourly
from martkit.sinks.zones import write_mart_days
from martkit.sources.zones import read_mart


@pytest.fixture
def stored(spark, tmp_path):
    both = mart_rows(spark, ["1", "2"]).union(mart_rows(spark, ["1"], "2024-06-14"))
    write_mart_days(both, str(tmp_path))
    return read_mart(spark, str(tmp_path))


def test_t13_columns(stored):
    assert sales_hourly(stored, DAY).columns == ["hh", "store_id", TOTAL]
    assert sales_hourly(stored, DAY, with_ymd=True).columns == ["ymd", "hh", "store_id", TOTAL]
    assert sales_daily(stored, DAY, total="yen").columns == ["ymd", "store_id", "yen"]


@pytest.mark.parametrize("rollup", [sales_hourly, sales_daily])
def test_p8_partition_filter_and_partial_sums(stored, rollup):
    frame = rollup(stored, DAY)
    assert "(retrieval_date#" in plan(frame) and "PartitionFilters: [isnotnull" in plan(frame)
    text = tree(frame)
    assert text.count("Exchange") == 1 and "partial_sum" in text
    assert "purchase_id" not in text
    assert frame.count() == 2


def test_hourly_sums_add_up_to_daily(spark):
    from martkit.catalogue.queries import mart

    rows = mart(spark, "/root/testdata/sf0.001")
    total = rows.groupBy().sum("sales_jpy").first()[0]
    for frame in (sales_hourly(rows), sales_daily(rows)):
        assert frame.groupBy().sum(TOTAL).first()[0] == pytest.approx(total, rel=1e-9)


@pytest.mark.parametrize("rollup", [sales_hourly, sales_daily])
def test_totals_do_not_depend_on_the_order(spark, rollup):
    rows = mart_rows(spark, ["1"]).drop("sales_jpy").crossJoin(spark.range(3000))
    mart = rows.selectExpr("*", "case id % 3 when 0 then 0.1d when 1 then 1e15d else -1e15d end sales_jpy")
    for parts in (1, 7):
        (row,) = rollup(mart.repartition(parts)).collect()
        assert row[TOTAL] == 100.0
