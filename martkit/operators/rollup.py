"""Roll-ups of the sales mart.

Yen are summed as decimals, so a total does not depend on the order of the rows or on how
they were dealt out, and rounded to a double once, at the end. An amount of 10**20 or more,
or one that is no number, raises.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Eight places hold what a rate of as many brings in; totals may reach 10**20.
EXACT, EXACT_TOTAL = "decimal(28,8)", "decimal(38,8)"

# Fixed value: the name reports give the total ("sales").
TOTAL = "売り上げ"


def sales_hourly(
    mart: DataFrame, day: str | None = None, with_ymd: bool = False, total: str = TOTAL
) -> DataFrame:
    """Yen per local day, hour and store, of one retrieval date or of all.

    As in the report it stands for, ``ymd`` is a grouping key but shown only on
    demand, so without it several rows may share hour and store.
    """
    summed = _of_day(mart, day).groupBy("ymd", "hh", "store_id").agg(_sum(total))
    return summed if with_ymd else summed.drop("ymd")


def sales_daily(mart: DataFrame, day: str | None = None, total: str = TOTAL) -> DataFrame:
    """Yen per local day and store, of one retrieval date or of all."""
    return _of_day(mart, day).groupBy("ymd", "store_id").agg(_sum(total))


def sales_daily_by_date(mart: DataFrame, total: str = TOTAL) -> DataFrame:
    """Yen per retrieval date, local day and store: :func:`sales_daily` of every date in one scan."""
    return mart.groupBy("retrieval_date", "ymd", "store_id").agg(_sum(total))


def _of_day(mart: DataFrame, day: str | None) -> DataFrame:
    return mart if day is None else mart.where(F.col("retrieval_date") == day)


def _sum(total: str):
    yen = F.sum(F.col("sales_jpy").cast(EXACT))
    return yen.cast(EXACT_TOTAL).cast("double").alias(total)
