"""Roll-ups that are kept up to date by changes rather than computed anew.

A roll-up stores, per group, the exact sum, the rows and the rows with an amount. A change
takes the row before out of its group and puts the row after into its own, so updates that
move a row to another day are right too. Sums are decimals: in whatever order changes are
added, the result is that of a roll-up computed anew.

Groups are stored by day. A window of changes is summed by group first; then only the days
that it touches are read, merged and replaced. A window is noted before and after it is
applied, and the days it replaced carry its end, so one that broke off half-way is
finished by applying it again, and no day takes it twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from martkit.operators.changes import AFTER, BEFORE
from martkit.operators.joins import lookup_join
from martkit.operators.versioned import VersionedTable
from martkit.session import materialize

TOTAL, ROWS, AMOUNTS, APPLIED = "total", "rows", "amounts", "applied"

# Amounts have 4 decimal places; sums have room for 10**20 of the greatest.
AMOUNT_TYPE, TOTAL_TYPE = "decimal(18,4)", "decimal(38,4)"

WINDOWS = StructType(
    [
        StructField("number", LongType()),
        StructField("begin", StringType()),
        StructField("end", StringType()),
        StructField("done", BooleanType()),
    ]
)


class WindowMismatch(ValueError):
    """The changes do not follow on what the roll-up holds."""


def exact_amount(amount: Column) -> Column:
    return amount.cast(AMOUNT_TYPE)


def group_totals(rows: DataFrame, keys: list[str], amount: str) -> DataFrame:
    """(keys, total, rows, amounts) of plain rows."""
    signed = rows.select(*keys, exact_amount(F.col(amount)).alias(TOTAL), F.lit(1).alias("sign"))
    return _summed(signed, keys)


def deltas(changes: DataFrame, keys: list[str], amount: str) -> DataFrame:
    """What changes (with ``before`` and ``after``) add to and take from each group.

    Groups for which they come to nothing are left out.
    """
    images = []
    for side, sign in ((BEFORE, -1), (AFTER, 1)):
        values = [F.col(f"{side}.`{key}`").alias(key) for key in keys]
        own = exact_amount(F.col(f"{side}.`{amount}`")) * F.lit(sign)
        image = F.struct(*values, own.cast(AMOUNT_TYPE).alias(TOTAL), F.lit(sign).alias("sign"))
        images.append(F.when(F.col(side).isNotNull(), image))
    signed = changes.select(F.explode(F.array(*images)).alias("image"))
    signed = signed.where(F.col("image").isNotNull()).select("image.*")
    something = (F.col(ROWS) != 0) | (F.col(AMOUNTS) != 0) | (F.col(TOTAL) != 0)
    return _summed(signed, keys).where(something)


def _summed(signed: DataFrame, keys: list[str]) -> DataFrame:
    held = F.when(F.col(TOTAL).isNotNull(), F.col("sign")).otherwise(0)
    return signed.groupBy(*keys).agg(
        F.coalesce(F.sum(TOTAL), F.lit(0)).cast(TOTAL_TYPE).alias(TOTAL),
        F.sum("sign").cast("bigint").alias(ROWS),
        F.sum(held).cast("bigint").alias(AMOUNTS),
    )


@dataclass(frozen=True)
class MaintainedRollup:
    """A roll-up stored at ``root``, by ``keys`` of which the first is the day.

    The folder ``rows`` holds the groups and ``windows`` what was applied. One writer at a
    time. Groups that lost all their rows stay stored with none and are not shown.
    """

    spark: SparkSession
    root: str
    keys: list[str]
    amount: str

    def start(self, rows: DataFrame, instant: str) -> None:
        """Compute the roll-up of all ``rows``, which are the state at ``instant``."""
        groups = group_totals(rows, self.keys, self.amount)
        self._write(groups.withColumn(APPLIED, F.lit(instant)), "static")
        self._note(0, instant, instant, True)

    def read(self) -> DataFrame:
        """(keys, total, rows): the groups that have rows; of amounts all null the total is null."""
        shown = self._stored().where(F.col(ROWS) > 0)
        total = F.when(F.col(AMOUNTS) > 0, F.col(TOTAL))
        return shown.select(*self.keys, total.alias(TOTAL), ROWS)

    def applied(self) -> str:
        """The instant up to which changes are in."""
        return self._windows()[0]

    def unfinished(self) -> tuple[str, str] | None:
        """The window that was begun but not finished, if any."""
        return self._windows()[1]

    def apply(self, changes: DataFrame, begin: str, end: str) -> None:
        """Merge the changes of the window (begin, end] into the days that they touch.

        Windows follow on one another; one that broke off has to come again first.
        """
        applied, broken = self._windows()
        if broken not in (None, (begin, end)) or begin != applied:
            raise WindowMismatch(f"{(begin, end)} does not follow on {broken or applied}")
        number = self._number()
        if broken is None:
            self._note(number, begin, end, False)
        self._merge(changes, end)
        self._note(number + 1, begin, end, True)

    def follow(self, table: VersionedTable) -> str:
        """Bring the roll-up up to the last commit of ``table``; gives that instant."""
        broken = self.unfinished()
        if broken:
            self.apply(table.changes(*broken), *broken)
        begin, end = self.applied(), table.commits()[-1].commit_time
        if begin < end:
            self.apply(table.changes(begin, end), begin, end)
        return end

    # -- helpers ---------------------------------------------------------

    def _merge(self, changes: DataFrame, end: str) -> None:
        day = self.keys[0]
        delta = materialize(deltas(changes, self.keys, self.amount), "rollup-deltas")
        touched = [row[0] for row in delta.select(day).distinct().collect()]
        if not touched:
            return
        stored = self.of_days(touched)
        # days that took this window before it broke off
        done = stored.where(F.col(APPLIED) >= end).select(day).distinct()
        done = done.withColumn("done", F.lit(True))
        key = F.coalesce(F.col(day).cast("string"), F.lit("null"))
        open_days = lookup_join(
            delta.withColumn("__day", key), done.select(key.alias("__day"), "done"), ["__day"]
        )
        delta = open_days.where(F.col("done").isNull()).select(*delta.columns)
        stored = lookup_join(
            stored.withColumn("__day", key), done.select(key.alias("__day"), "done"), ["__day"]
        )
        stored = stored.where(F.col("done").isNull()).select(*delta.columns)
        sums = [F.sum(c).cast(kind).alias(c) for c, kind in delta.dtypes if c not in self.keys]
        merged = stored.unionByName(delta).groupBy(*self.keys).agg(*sums)
        # stored aside first: the days that are replaced are those that are read
        merged = materialize(merged.withColumn(APPLIED, F.lit(end)), "rollup-merged")
        self._write(merged, "dynamic")

    def of_days(self, days: list) -> DataFrame:
        """The stored groups of some days; no other day's files are opened."""
        day = F.col(self.keys[0])
        known = [d for d in days if d is not None]
        wanted = day.isin(known)
        if None in days:
            wanted = wanted | day.isNull()
        return self._stored().where(wanted)

    def _stored(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/rows")

    def _write(self, groups: DataFrame, mode: str) -> None:
        day = self.keys[0]
        others = [c for c in groups.columns if c != day]
        writer = groups.select(*others, day).hint("rebalance", day).write.mode("overwrite")
        writer.option("partitionOverwriteMode", mode).partitionBy(day).parquet(f"{self.root}/rows")

    def _note(self, number: int, begin: str, end: str, done: bool) -> None:
        line = self.spark.createDataFrame([(number, begin, end, done)], WINDOWS).coalesce(1)
        line.write.mode("append").json(f"{self.root}/windows")

    def _lines(self) -> DataFrame:
        return self.spark.read.schema(WINDOWS).json(f"{self.root}/windows")

    def _number(self) -> int:
        return self._lines().agg(F.max("number")).first()[0] + 1

    def _windows(self) -> tuple[str, tuple[str, str] | None]:
        try:
            lines = self._lines()
        except AnalysisException as missing:
            raise WindowMismatch(f"there is no roll-up at {self.root}") from missing
        last = lines.agg(
            F.max_by("end", "number").alias("end"),
            F.max_by("begin", "number").alias("begin"),
            F.max_by("done", "number").alias("done"),
        ).first()
        if last["done"]:
            return last["end"], None
        return last["begin"], (last["begin"], last["end"])
