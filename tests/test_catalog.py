import pytest
from test_zones import DAY, mart_rows

from martkit.schemas import MART, MART_PARTITIONS
from martkit.sinks.catalog import (
    create_tables,
    missing_partitions,
    partition_exists,
    partitions_of,
    register_partition,
    register_partitions,
    registered_partitions,
)
from martkit.sinks.zones import write_mart_days
from martkit.sources.zones import read_mart

TABLE = "money_test.salesdata"


@pytest.fixture
def gold(spark, tmp_path):
    root = str(tmp_path / "salesdata")
    for _ in range(2):  # T12: creating again changes nothing
        create_tables(spark, str(tmp_path / "rates"), root, "master_test.currency_rates", TABLE)
    yield root
    spark.sql("DROP DATABASE money_test CASCADE")
    spark.sql("DROP DATABASE master_test CASCADE")


def test_k4_columns(spark, gold):
    found = [(f.name, f.dataType) for f in spark.table(TABLE).schema.fields]
    assert found == [(f.name, f.dataType) for f in MART.fields]
    assert spark.table("master_test.currency_rates").columns[-1] == "retrieval_date"


def test_k5_k7_k9_register_what_is_missing(spark, gold):
    write_mart_days(mart_rows(spark, ["1", "2"]), gold)
    assert spark.table(TABLE).count() == 0
    assert not partition_exists(spark, TABLE, {"retrieval_date": DAY, "store_id": "1"})

    present = partitions_of(read_mart(spark, gold), MART_PARTITIONS)
    missing = missing_partitions(present, TABLE, MART_PARTITIONS)
    assert register_partitions(missing, TABLE, MART_PARTITIONS) == 2
    assert spark.table(TABLE).count() == 2
    assert partition_exists(spark, TABLE, {"retrieval_date": DAY, "store_id": "1"})

    write_mart_days(mart_rows(spark, ["3"]), gold)
    missing = missing_partitions(
        partitions_of(read_mart(spark, gold), MART_PARTITIONS), TABLE, MART_PARTITIONS
    )
    assert [tuple(row) for row in missing.collect()] == [(DAY, "3")]
    assert register_partitions(present, TABLE, MART_PARTITIONS) == 2  # again: no change
    register_partitions(missing, TABLE, MART_PARTITIONS)
    assert spark.table(TABLE).count() == 3


def test_k8_one_partition_with_a_location(spark, gold, tmp_path):
    elsewhere = str(tmp_path / "elsewhere")
    write_mart_days(mart_rows(spark, ["9"]), elsewhere)
    values = {"retrieval_date": DAY, "store_id": "9"}
    register_partition(spark, TABLE, values, elsewhere)
    register_partition(spark, TABLE, values, elsewhere)
    assert [row.store_id for row in spark.table(TABLE).collect()] == ["9"]


def test_odd_partition_values(spark, gold):
    odd = ["a b", "a+b", "50%", "x=y", "it's", "大田"]
    write_mart_days(mart_rows(spark, odd), gold)
    present = partitions_of(read_mart(spark, gold), MART_PARTITIONS)
    register_partitions(present, TABLE, MART_PARTITIONS, location=gold)
    shown = registered_partitions(spark, TABLE, MART_PARTITIONS)
    assert {row.store_id for row in shown.collect()} == set(odd)
    assert spark.table(TABLE).count() == len(odd)
    assert missing_partitions(present, TABLE, MART_PARTITIONS).isEmpty()


def test_msck_finds_the_rest(spark, gold):
    write_mart_days(mart_rows(spark, ["1", "2"]), gold)
    spark.sql(f"MSCK REPAIR TABLE {TABLE}")
    assert spark.table(TABLE).count() == 2


def test_a1_a2_as_sql_text(spark, gold):
    """The roll-ups as users write them, with double-quoted identifiers."""
    write_mart_days(mart_rows(spark, ["1", "2"], n=3), gold)
    spark.sql(f"MSCK REPAIR TABLE {TABLE}")
    hourly = spark.sql(
        'SELECT hh, store_id, sum(sales_jpy) AS "売り上げ" FROM "money_test"."salesdata" '
        f"WHERE retrieval_date = '{DAY}' GROUP BY ymd, hh, store_id"
    )
    assert hourly.columns == ["hh", "store_id", "売り上げ"] and hourly.count() == 2
    daily = spark.sql(
        'SELECT ymd, store_id, sum(sales_jpy) AS "売り上げ" FROM "money_test"."salesdata" '
        f"WHERE retrieval_date = '{DAY}' GROUP BY ymd, store_id"
    )
    assert daily.count() == 2
