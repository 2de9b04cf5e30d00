"""From raw documents to packed training sequences, in five stages.

Each stage works on all rows that the one before kept, and its decisions take effect:
rejected documents go, one document of each group of near copies stays, personal data is
replaced, documents are repeated as the mix wants, and what is left is packed. Every
stage's rows are stored as Parquet and read again before the next one.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import martkit
from martkit.llm.common import table
from martkit.llm.jaccard import jaccard_components
from martkit.llm.language import fit_languages, keep_identified
from martkit.llm.mixing import COPIES, COPY, SHUFFLE, mix_sources
from martkit.llm.packing import pack_documents
from martkit.llm.pii import redact_pii
from martkit.llm.queries import tokenizer_path
from martkit.operators.joins import lookup_join
from martkit.session import materialize, shuffles_removed

cloudpickle.register_pickle_by_value(martkit)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Near copies: shingles of five words, similarity of 0.8.
WIDTH, PERCENT = 5, 80
KEY, ROWS = "__kept_key", "__kept_rows"


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not rejected; texts that are null or hold no letter are."""
    return keep_identified(docs, fit_languages(docs))


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least id.

    Documents that link with nothing stay. A document without an id stands behind all
    that have one. Of rows with one id and one text, one stays.
    """
    by_text = F.shiftrightunsigned(F.xxhash64(F.coalesce("text", F.lit(""))), 2)
    no_id = by_text.bitwiseOR(F.lit(1 << 62))
    rows = docs.withColumn(KEY, F.coalesce(F.col("doc_id").cast("bigint"), no_id))
    groups = jaccard_components(rows, PERCENT, WIDTH, key=KEY)
    stay = groups.where("component_id = doc_id").groupBy(F.col("doc_id").alias(KEY))
    # an id that occurs once is a plain look-up; the rows of others are compared
    with shuffles_removed(spark):
        ids = materialize(stay.agg(F.count(F.lit(1)).alias(ROWS)), "kept-ids")
    once = lookup_join(rows, ids.where(f"{ROWS} = 1"), [KEY], "inner")
    again = lookup_join(rows, ids.where(f"{ROWS} > 1"), [KEY], "inner")
    again = again.dropDuplicates([KEY, "text"])
    return once.select(*docs.columns).unionByName(again.select(*docs.columns))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind."""
    hidden = redact_pii(docs)
    return hidden.withColumn("n_chars", F.char_length("text").cast("bigint"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that every source weighs the same, in a shuffled order."""
    columns = [c for c in docs.columns if c not in (COPY, COPIES, SHUFFLE)]
    return mix_sources(docs).select(*columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in the packed sequences."""
    return pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_stage),
    ("ngram_jaccard_join", near_copies_stage),
    ("pii", personal_data_stage),
    ("mixing_sources", mixing_stage),
    ("best_fit_packing", packing_stage),
]

# Clustering, tokens and exact joins of shingles cannot be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
