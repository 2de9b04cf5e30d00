"""Currency conversion."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The units as the sales API spells them.
YEN = "yen"
US_DOLLAR = "us_doller"

KNOWN_SCALES = (YEN, US_DOLLAR)


def to_yen(scale: Column, amount: Column, yen_per_dollar: Column) -> Column:
    """Amount in yen; a unit that is unknown or null counts as yen."""
    return F.when(scale == US_DOLLAR, amount * yen_per_dollar).otherwise(amount)
