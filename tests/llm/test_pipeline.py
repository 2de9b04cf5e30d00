from pathlib import Path

import pytest
from llm_cases import awkward, empty
from pyspark.sql import functions as F

import corpus_pipeline
from martkit.llm.queries import QUERIES, op4_chat_format, op10_shard_feistel

SF_DIR = "/root/testdata/sf0.001"


def apply(spark, docs, folder):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out.append(docs)
    return out


def test_stages_on_the_small_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    named, single, hidden, mixed, packed = apply(spark, docs, tmp_path)
    for frame in (named, single, hidden, mixed):
        assert frame.columns == docs.columns
    assert 0.97 * docs.count() <= named.count() <= docs.count()
    assert single.count() == hidden.count() <= named.count()
    # exact copies are gone
    assert single.select("text").distinct().count() == single.count()
    assert hidden.where("text rlike '[a-z]@mail[0-9]'").isEmpty()
    tokens = packed.groupBy("sequence_id").sum("length").collect()
    assert packed.count() >= mixed.count() and all(r[1] <= 2048 for r in tokens)


@pytest.mark.parametrize("make", [awkward, empty])
def test_awkward_rows(spark, tmp_path, make):
    docs = make(spark)
    docs = docs.select(*docs.columns[:5], F.lit(None).cast("string").alias("__extra"))
    out = apply(spark, docs, tmp_path)
    assert all(frame.columns == docs.columns for frame in out[:4])


def test_one_of_each_group_stays(spark):
    rows = [(3, "a b c d e f g"), (1, "a b c d e f g"), (1, "a b c d e f g"), (None, "a b c d e f g")]
    rows += [(None, "z y x"), (None, "z y x"), (7, None), (8, None), (9, "other words here to keep")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = corpus_pipeline.near_copies_stage(spark, docs, SF_DIR).collect()
    assert sorted(map(tuple, kept), key=str) == sorted(
        [(1, "a b c d e f g"), (None, "z y x"), (7, None), (8, None), (9, "other words here to keep")],
        key=str,
    )


def test_near_copies_leave_no_shuffles_behind(spark):
    def left():
        disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        files = [p.name for d in disk.localDirsString() for p in Path(d).rglob("shuffle_*")]
        return {name.split("_")[1] for name in files}

    rows = [(i, f"{i % 7} b c d e f g h i j k l {i % 3}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    before = left()
    kept = corpus_pipeline.near_copies_stage(spark, docs, SF_DIR)
    # only what is measured for the last look-ups
    assert len(left() - before) <= 5
    assert 0 < kept.count() <= 21


def test_contracts_of_the_thin_queries(spark):
    chats = op4_chat_format(spark, SF_DIR)
    extra = chats.where("conv_id = -7").first()
    assert extra["n_turns"] == 2 and extra["loss_chars"] == len("\\### Assistant: </turn> ok")
    shards = op10_shard_feistel(spark, SF_DIR)
    assert dict(shards.dtypes)["grown_shard"] == "int"
    assert len({name.split("_")[0] for name in QUERIES}) == 10
