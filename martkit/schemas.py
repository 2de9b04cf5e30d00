"""Schemas of the files, tables and JSON documents."""

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


# One sale inside an API page.
SALE = struct(
    store_id=IntegerType(),
    purchase_id=StringType(),
    scale=StringType(),
    store_name=StringType(),
    time=TimestampType(),
    sales=DoubleType(),
)

# One API page.
ENVELOPE = struct(
    page=IntegerType(),
    per_page=IntegerType(),
    total_pages=IntegerType(),
    total_items=IntegerType(),
    data=ArrayType(SALE),
)

# ``error`` says why a page has no body, if it could not be fetched.
FETCHED = struct(page=LongType(), sales_data=StringType(), error=StringType())

RAW_SALES = StructType(
    [StructField("page", LongType()), *SALE.fields, StructField("retrieval_date", StringType())]
)

# Exchange-rate snapshot document and the table made of it. Rates are read as text, so
# that a damaged one does not take the others with it.
RATES_DOCUMENT = struct(timestamp=LongType(), rates=MapType(StringType(), StringType()))
RATES = struct(currency=StringType(), rates=DoubleType(), retrieval_date=StringType())

# Columns of the mart, the two partition columns last.
MART = struct(
    page=IntegerType(),
    purchase_id=StringType(),
    scale=StringType(),
    store_name=StringType(),
    time=TimestampType(),
    sales=DoubleType(),
    sales_jpy=DoubleType(),
    ymd=DateType(),
    hh=StringType(),
    retrieval_date=StringType(),
    store_id=StringType(),
)
MART_PARTITIONS = ["retrieval_date", "store_id"]
RATES_PARTITIONS = ["retrieval_date"]

# Reverse-geocoder answer; the box is [south, north, west, east] as text.
GEO_RESPONSE = struct(
    place_id=LongType(),
    osm_type=StringType(),
    osm_id=LongType(),
    lat=StringType(),
    lon=StringType(),
    place_rank=IntegerType(),
    importance=DoubleType(),
    name=StringType(),
    display_name=StringType(),
    address=struct(city=StringType(), country=StringType(), country_code=StringType()),
    boundingbox=ArrayType(StringType()),
)
