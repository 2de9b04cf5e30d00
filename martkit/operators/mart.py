"""Raw sales and daily rates to the sales mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.functions.money import to_yen
from martkit.functions.times import LOCAL_ZONE, local_day, local_hour
from martkit.operators.joins import BROADCAST_ROWS, HOT_ROWS, lookup_join
from martkit.schemas import MART
from martkit.session import require_utc


def currency_rates(rates: DataFrame, currency: str = "JPY") -> DataFrame:
    """Rates of one currency; the filter reaches the scan."""
    return rates.where(F.col("currency") == currency)


def join_rates(
    sales: DataFrame,
    rates: DataFrame,
    currency: str = "JPY",
    max_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Sales with the rate of their retrieval date; sales without one are lost.

    A date is a hot key by nature, all of a day's sales share it, so the rates
    are never joined by a plain shuffle on the date.
    """
    return lookup_join(
        sales,
        currency_rates(rates, currency).select("retrieval_date", "currency", "rates"),
        ["retrieval_date"],
        "inner",
        max_rows=max_rows,
        hot_rows=hot_rows,
    )


def unmatched_sales(sales: DataFrame, rates: DataFrame, currency: str = "JPY") -> DataFrame:
    """Sales that :func:`join_rates` loses for want of a rate."""
    dates = currency_rates(rates, currency).select("retrieval_date").distinct()
    return lookup_join(sales, dates, ["retrieval_date"], "left_anti")


def convert_to_yen(priced: DataFrame) -> DataFrame:
    amount = to_yen(F.col("scale"), F.col("sales"), F.col("rates"))
    return priced.withColumn("sales_jpy", amount)


def split_local_time(sales: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Add ``ymd`` and ``hh``, the local day and hour of ``time`` (UTC)."""
    require_utc(sales.sparkSession)
    time = F.col("time")
    return sales.withColumns({"ymd": local_day(time, zone), "hh": local_hour(time, zone)})


def build_mart(
    sales: DataFrame, rates: DataFrame, currency: str = "JPY", zone: str = LOCAL_ZONE
) -> DataFrame:
    """The mart rows of any number of days, in one narrow pass over the sales."""
    priced = join_rates(sales, rates, currency).transform(convert_to_yen)
    local = priced.transform(split_local_time, zone)
    return local.select(*[F.col(f.name).cast(f.dataType) for f in MART.fields])
