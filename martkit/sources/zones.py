"""Readers of the raw and gold zones."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martkit.schemas import MART, RATES, RAW_SALES


def read_raw_day(spark: SparkSession, root: str, day: str) -> DataFrame:
    """All hours of one day of the raw zone, ``root/day/hour/``."""
    return spark.read.schema(RAW_SALES).parquet(f"{root}/{day}/*")


def read_rates(spark: SparkSession, root: str, day: str | None = None) -> DataFrame:
    """Rates of one day, or of all days."""
    return _read_days(spark, RATES, root, day)


def read_mart(spark: SparkSession, root: str, day: str | None = None) -> DataFrame:
    """Mart rows of one day, or of all days."""
    return _read_days(spark, MART, root, day)


def _read_days(spark: SparkSession, schema: StructType, root: str, day: str | None) -> DataFrame:
    """For one day only its own folder is listed; a day without one has no rows."""
    if day is None:
        return spark.read.schema(schema).parquet(root)
    reader = spark.read.schema(schema).option("basePath", root)
    try:
        rows = reader.parquet(f"{root}/retrieval_date={day}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return rows.where(F.col("retrieval_date") == day)
