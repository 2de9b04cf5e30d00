"""Coordinate expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Level 0 is one cell of 360 degrees, every further level halves it.
MAX_LEVEL = 20


def coordinate(latlon: Column, name: str) -> Column:
    """``name`` out of ``lat=..&lon=..`` as a double, null when malformed."""
    return F.regexp_extract(latlon, f"(?:^|&){name}=([^&]*)", 1).try_cast("double")


def on_globe(lat: Column, lon: Column) -> Column:
    return lat.between(-90, 90) & lon.between(-180, 180)


def grid_level(side: Column) -> Column:
    """Finest level whose cells are no narrower than a box of this height, or width."""
    extent = F.greatest(side, F.lit(360.0 / 2**MAX_LEVEL))
    return F.least(
        F.lit(MAX_LEVEL), F.greatest(F.lit(0), F.floor(F.log2(F.lit(360.0) / extent)))
    ).cast("int")


def cell_row(lat: Column, level: Column) -> Column:
    return F.floor((lat + 90) * F.pow(F.lit(2.0), level) / 360)


def cell_column(lon: Column, level: Column) -> Column:
    return F.floor((lon + 180) * F.pow(F.lit(2.0), level) / 360)


def level_pair(row_level: Column, column_level: Column) -> Column:
    """Both levels in one number."""
    return (row_level * 32 + column_level).cast("int")


def cell_key(pair: Column, row: Column, column: Column) -> Column:
    """Levels, row and column packed into one bigint join key."""
    return pair.cast("bigint") * (1 << 44) + row * (1 << 22) + column
