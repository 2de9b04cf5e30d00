import pytest
from fixtures import DAY, RATES_DOCUMENT
from plans import plan

from martkit.operators.mart import currency_rates
from martkit.operators.quality import DuplicateKeys
from martkit.plans.jobs import load_rates
from martkit.sinks.catalog import create_table, registered_partitions
from martkit.schemas import RATES, RATES_PARTITIONS
from martkit.sources.rates import rates_from_documents
from martkit.sources.zones import read_rates

GOLDEN = {("JPY", 156.79364286, DAY), ("EUR", 0.93, DAY), ("USD", 1.0, DAY)}


def test_m1_map_to_rows(spark):
    rates = rates_from_documents(spark.createDataFrame([(RATES_DOCUMENT,)], "value string"))
    assert rates.columns == ["currency", "rates", "retrieval_date"]
    assert {tuple(row) for row in rates.collect()} == GOLDEN


def test_s8_k3_documents_to_partition(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "latest.json").write_text(RATES_DOCUMENT)
    root = str(tmp_path / "rates")
    spark.sql("CREATE DATABASE IF NOT EXISTS rates_test")
    create_table(spark, "rates_test.currency_rates", RATES, RATES_PARTITIONS, root)
    for _ in range(2):
        load_rates(spark, str(tmp_path / "in"), root, "rates_test.currency_rates")
    assert len(list((tmp_path / "rates" / f"retrieval_date={DAY}").glob("*.parquet"))) == 1
    assert {tuple(row) for row in read_rates(spark, root, DAY).collect()} == GOLDEN
    shown = registered_partitions(spark, "rates_test.currency_rates", RATES_PARTITIONS)
    assert [row[0] for row in shown.collect()] == [DAY]
    assert spark.table("rates_test.currency_rates").count() == 3


def test_s5_partition_and_currency_reach_the_scan(spark, tmp_path):
    documents = spark.createDataFrame([(RATES_DOCUMENT,)], "value string")
    documents.write.text(str(tmp_path / "in"))
    root = str(tmp_path / "rates")
    load_rates(spark, str(tmp_path / "in"), root)
    text = plan(currency_rates(read_rates(spark, root, DAY)))
    assert "PartitionFilters: [isnotnull(retrieval_date" in text
    assert "EqualTo(currency,JPY)" in text


def test_t8_two_documents_of_a_day_are_refused(spark, tmp_path):
    documents = spark.createDataFrame([(RATES_DOCUMENT,), (RATES_DOCUMENT,)], "value string")
    documents.coalesce(1).write.text(str(tmp_path / "in"), lineSep="\n")
    for i in range(2):
        (tmp_path / "in" / f"{i}.txt").write_text(RATES_DOCUMENT)
    with pytest.raises(DuplicateKeys, match="retrieval_date, currency"):
        load_rates(spark, str(tmp_path / "in" / "[01].txt"), str(tmp_path / "rates"))
