"""External tables over the gold zone and their explicitly registered partitions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import batched

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martkit.schemas import MART, MART_PARTITIONS, RATES, RATES_PARTITIONS
from martkit.session import materialize

RATES_TABLE = "master.currency_rates"
MART_TABLE = "money.salesdata"

# Fixed value: how a partition path spells null.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

# Days up to which the catalog is asked day by day for what it knows of them.
LISTED_DAYS = 64

# Partitions per ALTER TABLE statement.
STATEMENT_SIZE = 500


def create_tables(
    spark: SparkSession,
    rates_location: str,
    mart_location: str,
    rates_table: str = RATES_TABLE,
    mart_table: str = MART_TABLE,
) -> None:
    """Create both tables and their databases unless they exist."""
    create_table(spark, rates_table, RATES, RATES_PARTITIONS, rates_location)
    create_table(spark, mart_table, MART, MART_PARTITIONS, mart_location)


def create_table(
    spark: SparkSession, table: str, schema: StructType, partitions: list[str], location: str
) -> None:
    database = table.split(".")[0]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING PARQUET "
        f"PARTITIONED BY ({', '.join(partitions)}) LOCATION {_text(location)} "
        "TBLPROPERTIES ('parquet.compression' = 'snappy')"
    )


def partitions_of(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct partition values that ``rows`` hold."""
    return rows.select(*keys).distinct()


def registered_partitions(
    spark: SparkSession, table: str, keys: list[str], within: dict[str, str] | None = None
) -> DataFrame:
    """Partition values the catalog knows for ``table``, all or those ``within`` values."""
    levels = F.split("partition", "/")
    part = ", ".join(f"{key} = {_text(value)}" for key, value in (within or {}).items())
    listed = spark.sql(f"SHOW PARTITIONS {table}" + (f" PARTITION ({part})" if part else ""))
    return listed.select(*[_path_value(levels[i], key).alias(key) for i, key in enumerate(keys)])


def partition_exists(spark: SparkSession, table: str, values: dict[str, str]) -> bool:
    """Asks the catalog for this one partition only."""
    return not registered_partitions(spark, table, list(values), values).isEmpty()


def missing_partitions(present: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Those of the ``present`` partitions that the catalog does not know.

    The catalog lists only days that ``present`` holds, unless these are very many.
    """
    spark = present.sparkSession
    days = [row[0] for row in present.select(keys[0]).distinct().limit(LISTED_DAYS + 1).collect()]
    if len(days) > LISTED_DAYS or None in days:
        known = registered_partitions(spark, table, keys)
    else:
        lists = [registered_partitions(spark, table, keys, {keys[0]: day}) for day in days]
        known = reduce(DataFrame.union, lists) if lists else present.select(*keys).limit(0)
    on = [present[key].eqNullSafe(known[key]) for key in keys]
    return present.select(*keys).join(known, reduce(lambda a, b: a & b, on), "left_anti")


def stale_partitions(
    present: DataFrame, table: str, keys: list[str], within: dict[str, str] | None = None
) -> DataFrame:
    """Partitions the catalog knows, all or those ``within`` values, that are not ``present``."""
    known = registered_partitions(present.sparkSession, table, keys, within)
    on = [present[key].eqNullSafe(known[key]) for key in keys]
    return known.join(present, reduce(lambda a, b: a & b, on), "left_anti")


@dataclass(frozen=True)
class Reconciled:
    """Numbers of partitions that were added to the catalog and dropped from it."""

    added: int
    dropped: int


def reconcile_partitions(
    present: DataFrame,
    table: str,
    keys: list[str],
    within: dict[str, str] | None = None,
    location: str | None = None,
    allow_empty: bool = False,
) -> Reconciled:
    """Make the catalog list exactly the ``present`` partitions, all or those ``within`` values.

    The difference is taken both ways: what is stored but not listed is added, what is
    listed but no longer stored is dropped, additions first. Dropping concerns the catalog
    only, the files of an external table stay. With nothing present, which would drop all,
    this raises unless ``allow_empty``.
    """
    # both looks at the partitions see the same
    present = materialize(present.select(*keys), "present-partitions")
    for key, value in (within or {}).items():
        other = present.where(~F.col(key).eqNullSafe(F.lit(value)))
        if not other.isEmpty():
            raise ValueError(f"partitions outside of {key} = {value} are present")
    if not allow_empty and present.isEmpty():
        raise ValueError(f"no partitions are present; those of {table} are kept")
    known = registered_partitions(present.sparkSession, table, keys, within)
    on = [present[key].eqNullSafe(known[key]) for key in keys]
    missing = present.join(known, reduce(lambda a, b: a & b, on), "left_anti")
    stale = stale_partitions(present, table, keys, within)
    added = register_partitions(missing, table, keys, location)
    return Reconciled(added, drop_partitions(stale, table, keys))


def drop_partitions(stale: DataFrame, table: str, keys: list[str]) -> int:
    """Take partitions out of the catalog, in batches; their files stay."""
    dropped = 0
    for batch in batched(stale.select(*keys).toLocalIterator(), STATEMENT_SIZE):
        parts = ", ".join(_partition(row.asDict(), None) for row in batch)
        stale.sparkSession.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}")
        dropped += len(batch)
    return dropped


def relocate_partitions(rows: DataFrame, table: str, keys: list[str], location: str) -> int:
    """Point partitions that the catalog knows to their folders under ``location``."""
    moved = 0
    for row in rows.select(*keys).toLocalIterator():
        values = row.asDict()
        spec, path = _partition(values, None), _path(values)
        rows.sparkSession.sql(
            f"ALTER TABLE {table} {spec} SET LOCATION {_text(f'{location}/{path}')}"
        )
        moved += 1
    return moved


def register_partitions(
    missing: DataFrame, table: str, keys: list[str], location: str | None = None
) -> int:
    """Add partitions in batches; files stay invisible to the table until then.

    Partitions lie under the table's own location, or under ``location``.
    Adding one that exists changes nothing. Values reach the driver batch by
    batch, never as a whole.
    """
    added = 0
    rows = missing.select(*keys).toLocalIterator()
    for batch in batched(rows, STATEMENT_SIZE):
        parts = " ".join(_partition(row.asDict(), location) for row in batch)
        missing.sparkSession.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")
        added += len(batch)
    return added


def register_partition(
    spark: SparkSession, table: str, values: dict[str, str], location: str | None = None
) -> None:
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {_partition(values, location)}")


def _partition(values: dict[str, str], location: str | None) -> str:
    spec = ", ".join(f"{key} = {_text(value)}" for key, value in values.items())
    if location is None:
        return f"PARTITION ({spec})"
    return f"PARTITION ({spec}) LOCATION {_text(f'{location}/{_path(values)}')}"


def _path(values: dict[str, str]) -> str:
    return "/".join(f"{key}={_path_text(value)}" for key, value in values.items())


def _text(value: str | None) -> str:
    if value is None:
        return "NULL"
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


# Characters that Hive-style partition paths write as %XX.
_ESCAPED = set("\"#%'*/:=?\\{[]^\x7f") | {chr(code) for code in range(1, 32)}


def _path_text(value: str | None) -> str:
    if value is None:
        return NULL_PARTITION
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in value)


def _path_value(level, key: str):
    encoded = F.substr(level, F.lit(len(key) + 2))
    decoded = F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))
    return F.nullif(decoded, F.lit(NULL_PARTITION))
