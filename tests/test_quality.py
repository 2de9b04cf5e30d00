from collections import Counter

import pytest
from plans import tree
from pyspark.sql import functions as F

from martkit.operators.quality import DuplicateKeys, assert_unique, duplicate_keys, key_counts

KEYS = ["a", "a", "b", None, None]


@pytest.fixture
def purchases(spark):
    return spark.createDataFrame([(k, i) for i, k in enumerate(KEYS)], "purchase_id string, n int")


@pytest.mark.parametrize("bounds", [{}, {"max_rows": 0, "hot_rows": 1}])
def test_q1_counts_on_rows(purchases, bounds):
    counted = key_counts(purchases, "purchase_id", **bounds)
    assert counted.columns == ["purchase_id", "n", "count"]
    found = Counter((row.purchase_id, row["count"]) for row in counted.collect())
    assert found == {("a", 2): 2, ("b", 1): 1, (None, 0): 2}


def test_q1_equals_the_window(spark):
    """Half of the rows share a key; every path gives what the window gives."""
    key = F.when(F.col("id") % 2 == 0, 0).when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 90)
    df = spark.range(3000).select(key.alias("k"), "id")
    want = sorted(map(tuple, df.selectExpr("k", "id", "count(k) over (partition by k)").collect()), key=str)
    for bounds in ({}, {"max_rows": 5, "hot_rows": 50}):
        assert sorted(map(tuple, key_counts(df, "k", **bounds).collect()), key=str) == want


def test_q1_has_no_window(purchases):
    assert "Window" not in tree(key_counts(purchases, "purchase_id"))


def test_t5_nulls_are_no_violation_by_default(purchases):
    rows = duplicate_keys(purchases, ["purchase_id"]).collect()
    assert [tuple(row) for row in rows] == [("a", 2)]
    rows = duplicate_keys(purchases, ["purchase_id"], nulls_as_violation=True).collect()
    assert {row.purchase_id for row in rows} == {"a", None}


def test_q2_shuffles_partial_counts_only(spark, purchases, tmp_path):
    purchases.write.parquet(str(tmp_path / "sales"))
    text = tree(duplicate_keys(spark.read.parquet(str(tmp_path / "sales")), ["purchase_id"]))
    assert text.index("partial_count") > text.index("Exchange hashpartitioning")
    assert "struct<purchase_id:string>" in text


def test_q3_error_or_warning(purchases):
    with pytest.raises(DuplicateKeys, match=r"non-unique purchase_id: \['a'\]"):
        assert_unique(purchases, ["purchase_id"])
    with pytest.warns(UserWarning, match="purchase_id"):
        assert_unique(purchases, ["purchase_id"], on_fail="warn")
    assert_unique(purchases, ["purchase_id", "n"])
    with pytest.raises(ValueError):
        assert_unique(purchases, ["n"], on_fail="ignore")


def test_q3_listing_is_bounded(spark):
    twice = spark.range(100).union(spark.range(100))
    with pytest.raises(DuplicateKeys, match="and more") as error:
        assert_unique(twice, ["id"], max_listed=3)
    assert str(error.value).count(",") == 2
