"""Write, audit, publish: a table shows a new mart of a day only when it is whole.

A run writes the day to a folder of its own, ``root/_runs/day/run``, which no reader sees.
What it wrote is counted while it is written and audited as it was stored. Only then are
the day's partitions in the catalog pointed to the new folder. Until that, and if any of
it fails, the table shows the day as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martkit.operators.quality import assert_unique
from martkit.schemas import MART, MART_PARTITIONS
from martkit.session import materialize
from martkit.sinks.catalog import (
    drop_partitions,
    partitions_of,
    register_partitions,
    registered_partitions,
    relocate_partitions,
    stale_partitions,
)
from martkit.sinks.zones import EmptyOverwrite

# Hidden from readers of the root: Spark skips folders whose names begin so.
RUNS = "_runs"

DAY = MART_PARTITIONS[0]


class AuditFailed(ValueError):
    """What was written is not what was to be written; the table still shows the old day."""


@dataclass(frozen=True)
class Run:
    """A written and not necessarily published mart of one day.

    ``counted`` holds the figures that were taken while it was written.
    """

    day: str
    name: str
    root: str
    counted: Mapping[str, int]

    @property
    def path(self) -> str:
        return f"{self.root}/{DAY}={self.day}"

    def rows(self, spark: SparkSession) -> DataFrame:
        """The stored rows; a run without any has no folder of the day."""
        try:
            return spark.read.schema(MART).option("basePath", self.root).parquet(self.path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], MART)


def run_root(root: str, day: str, name: str) -> str:
    return f"{root}/{RUNS}/{day}/{name}"


def write_run(
    mart: DataFrame,
    root: str,
    day: str,
    name: str | None = None,
    keep: Column | None = None,
    metrics: Mapping[str, Column] | None = None,
) -> Run:
    """Write a day to a folder of its own, counting rows as they pass; nothing is shown yet.

    ``metrics`` are aggregates over all rows of ``mart``; of these only the ones that
    ``keep`` holds for are written. Counting takes no further pass. It stands behind the
    shuffle, in the tasks that write, so that a stage run again is not counted twice.
    """
    name = name or uuid.uuid4().hex
    target = run_root(root, day, name)
    kept = F.lit(True) if keep is None else F.coalesce(keep, F.lit(False))
    figures = {
        "rows": F.count_if(kept),
        "other_days": F.count_if(kept & ~F.col(DAY).eqNullSafe(F.lit(day))),
        **(metrics or {}),
    }
    seen = Observation(f"run {name}")
    placed = mart.hint("rebalance", "store_id")
    observed = placed.observe(seen, *[one.alias(alias) for alias, one in figures.items()])
    rows = observed.where(kept).select(*MART.names)
    writer = rows.write.option("compression", "snappy").partitionBy(*MART_PARTITIONS)
    # a name that was used already is not written over
    writer.mode("error").parquet(target)
    return Run(day, name, target, dict(seen.get))


def audit_run(
    spark: SparkSession,
    run: Run,
    on_duplicate: str = "error",
    allow_empty: bool = False,
    key: str = "purchase_id",
) -> None:
    """Compare what is stored with what was counted, and check its keys.

    Reads one column of the run, and nothing of what it was made of.
    """
    if run.counted["other_days"]:
        raise AuditFailed(f"{run.counted['other_days']} rows are of other days than {run.day}")
    if not run.counted["rows"] and not allow_empty:
        raise EmptyOverwrite(f"no mart rows for {run.day}; the published ones are kept")
    stored = run.rows(spark)
    found = stored.count()
    if found != run.counted["rows"]:
        raise AuditFailed(f"{found} rows are stored of {run.counted['rows']} for {run.day}")
    assert_unique(stored, [key], on_duplicate)


@dataclass(frozen=True)
class Published:
    """Partitions of the day that are new, that now show the run, and that are gone."""

    added: int
    moved: int
    dropped: int


def publish_run(spark: SparkSession, run: Run, table: str) -> Published:
    """Make the table show the run in place of what it showed of its day.

    Nothing but catalog statements is left to do at this point, one for each store that was
    there before and one for every few hundred others. A reader in between may see stores
    of both runs, but never part of a store. A publication that broke off is finished by
    publishing the run again.
    """
    within = {DAY: run.day}
    present = materialize(partitions_of(run.rows(spark), MART_PARTITIONS), "run-partitions")
    known = materialize(
        registered_partitions(spark, table, MART_PARTITIONS, within), "known-partitions"
    )
    on = [present[key].eqNullSafe(known[key]) for key in MART_PARTITIONS]
    same = reduce(lambda a, b: a & b, on)
    moved = relocate_partitions(
        present.join(known, same, "left_semi"), table, MART_PARTITIONS, run.root
    )
    added = register_partitions(
        present.join(known, same, "left_anti"), table, MART_PARTITIONS, run.root
    )
    stale = stale_partitions(present, table, MART_PARTITIONS, within)
    dropped = drop_partitions(stale, table, MART_PARTITIONS)
    spark.catalog.refreshTable(table)
    return Published(added, moved, dropped)


def runs_shown(spark: SparkSession, table: str, day: str) -> list[str]:
    """Names of the runs whose files the table shows for a day: one, unless it is being published."""
    path = F.col("_metadata.file_path")
    name = F.regexp_extract(path, f"/{RUNS}/[^/]+/([^/]+)/", 1)
    shown = spark.table(table).where(F.col(DAY) == day).select(name.alias("name")).distinct()
    return sorted(row["name"] for row in shown.collect())


def remove_run(spark: SparkSession, root: str, day: str, name: str, table: str) -> None:
    """Delete a run that the table no longer shows."""
    if name in runs_shown(spark, table, day):
        raise ValueError(f"run {name} of {day} is shown by {table}")
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_root(root, day, name))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
