from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from plans import tree
from pyspark.sql import functions as F

from martkit.operators import joins
from martkit.operators.joins import WEIGHT, fits_broadcast, lookup_join, measure


def test_measure(spark):
    df = spark.createDataFrame([("abc", 1.0, [1]), (None, 2.0, [2])], "s string, d double, a array<int>")
    rows, size = measure(df)
    assert rows == 2 and 40 < size < 200
    assert measure(df.limit(0)) == (0, 0)
    assert fits_broadcast(df, 2, 200)
    assert not fits_broadcast(df, 1, 200) and not fits_broadcast(df, 2, 40)


def expected(rows, lookup, how):
    table = {}
    for key, value in lookup:
        table.setdefault(key, []).append(value)
    found = []
    for key, n in rows:
        hits = table.get(key, []) if key is not None else []
        if how == "left_anti":
            found += [(key, n)] if not hits else []
        else:
            found += [(key, n, value) for value in hits]
            found += [(key, n, None)] if not hits and how == "left" else []
    return Counter(found)


keys = st.one_of(st.none(), st.integers(0, 4))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(keys, max_size=60), st.lists(keys, max_size=8), st.sampled_from(["left", "inner", "left_anti"]))
def test_all_paths_agree_with_brute_force(spark, left, right, how):
    rows = list(zip(left, range(len(left))))
    lookup = [(key, f"v{i}") for i, key in enumerate(right)]
    many = spark.createDataFrame(rows, "k int, n int")
    few = spark.createDataFrame(lookup, "k int, v string")
    want = expected(rows, lookup, how)
    for bounds in ({}, {"max_rows": -1, "hot_rows": 3}, {"max_rows": -1, "hot_rows": 1000}):
        found = lookup_join(many, few, ["k"], how, **bounds)
        assert Counter(map(tuple, found.collect())) == want


def test_hot_key_is_spread_over_tasks(spark, set_conf):
    """Half of the rows share one key, a quarter have none; no task gets them all."""
    set_conf(
        spark__sql__adaptive__enabled="false",
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="8",
    )
    key = F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 4 == 1, None).otherwise(F.col("id"))
    many = spark.range(8000).select(key.alias("k"), "id")
    few = spark.range(8000).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    joined = lookup_join(many, few, ["k"], max_rows=10, hot_rows=100)
    assert "SortMergeJoin" in tree(joined)
    sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 8 and max(row["count"] for row in sizes) < 2500
    totals = joined.agg(F.count("*"), F.sum("v"), F.count_if(F.col("v").isNull())).first()
    assert tuple(totals) == (8000, 4000 * 70 + 10 * sum(range(3, 8000, 4)), 2000)


def test_hot_keys_are_few_by_construction(spark):
    weights = spark.range(1000).select(F.col("id").alias("k"), F.lit(1_000).alias(WEIGHT))
    assert joins._hot_keys(weights, ["k"], 2_000).count() == 0
    hot = joins._hot_keys(weights, ["k"], 100)
    assert {row[joins.SALTS] for row in hot.collect()} == {10}


def test_given_weights_save_the_count(spark):
    many = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 0)], "k int, n int")
    few = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    weights = spark.createDataFrame([(1, 50), (2, 1)], f"k int, {WEIGHT} long")
    joined = lookup_join(many, few, ["k"], weights=weights, max_rows=1, hot_rows=10)
    assert Counter(row.v for row in joined.collect()) == {"a": 50, "b": 1}


def test_unsupported_join(spark):
    with pytest.raises(ValueError):
        lookup_join(spark.range(1), spark.range(1), ["id"], "full")
