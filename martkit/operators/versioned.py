"""Keyed, versioned table: an append-only log of commits on plain Parquet.

Every commit appends its rows, or tombstones, under its own directory and then
one line to the timeline. Readers open only the directories the timeline names,
so a commit that died half-way stays invisible. Of two writers that begin from the same
state, the one that is late is refused.

    root/<generation>/log/_commit_time=<instant>/_try=<id>/   rows and tombstones of a commit
    root/<generation>/state/<id>/                             live rows as of a commit (compact)
    root/timeline/                                            one JSON line per commit

The line names the folder, so a try that came to nothing or was refused is never read.

``create`` starts a new generation; lines of older ones no longer count.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from martkit.operators.changes import row_changes
from martkit.operators.joins import lookup_join
from martkit.operators.types import common_type
from martkit.session import create_file, materialize

COMMIT = "_commit_time"
DELETED = "_deleted"
RECORD_KEY = "_record_key"
PARTITION_PATH = "_partition_path"
TRY = "_try"
RANK = "__rank"
# What reads add to rows or writes keep with them; a batch's columns of these names are
# not stored, so rows of a snapshot can be written back.
RESERVED = (COMMIT, DELETED, RECORD_KEY, PARTITION_PATH, RANK, TRY)

COMMIT_FIELD = StructField(COMMIT, StringType())
DELETED_FIELD = StructField(DELETED, BooleanType())

TIMELINE = StructType(
    [
        StructField("number", LongType()),
        *[
            StructField(name, StringType())
            for name in (
                "commit_time",
                "operation",
                "schema",
                "key",
                "partition",
                "precombine",
                "generation",
                "folder",
            )
        ],
    ]
)

# Milliseconds: yyyyMMddHHmmssSSS.
INSTANT = re.compile(r"\d{17}")
LAST = "9" * 17


class ConcurrentCommit(RuntimeError):
    """Another writer committed since this one began; the table is as that one left it."""


class NoSuchTable(ValueError):
    """There is no committed table at the path."""


def newest_first(columns: Iterable[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def latest_versions(log: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row of each key in ``order``.

    Written as rank 1 so that Spark keeps one row per key in every map task
    before the shuffle: a key with very many versions stays cheap.
    """
    ranked = log.withColumn(RANK, F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where(F.col(RANK) == 1).drop(RANK)


def live_rows(log: DataFrame, key: str, order: tuple[str, ...] = (COMMIT,)) -> DataFrame:
    """Version of each key that is greatest by ``order``, unless it is a tombstone."""
    latest = latest_versions(log, key, newest_first(order))
    return latest.where(~F.coalesce(F.col(DELETED), F.lit(False))).drop(DELETED)


def one_per_key(batch: DataFrame, key: str, precombine: str) -> DataFrame:
    """The batch row of each key with the greatest ``precombine``.

    Equal values are told apart by row hash, so a re-run picks the same row.
    """
    tie = F.xxhash64(*[F.col(c) for c in batch.columns])
    return latest_versions(batch, key, [*newest_first([precombine]), tie])


def evolve(old: StructType, new: StructType, case_sensitive: bool = False) -> StructType:
    """``old`` plus the columns only ``new`` has, each of a type that holds both sides' values.

    A column whose types have no such type in common is an error. Names are the same as the
    session resolves them; the stored spelling stays.
    """

    def folded(name: str) -> str:
        return name if case_sensitive else name.lower()

    brought = {folded(field.name): field for field in new.fields}
    fields = []
    for field in old.fields:
        other = brought.pop(folded(field.name), field)
        kind = common_type(field.dataType, other.dataType)
        if kind is None:
            raise ValueError(
                f"column {other.name} is {field.dataType.simpleString()}, "
                f"not {other.dataType.simpleString()}"
            )
        fields.append(StructField(field.name, kind, field.nullable))
    added = [StructField(f.name, f.dataType) for f in brought.values()]
    return StructType([*fields, *added])


def as_schema(
    rows: DataFrame, schema: StructType, only: list[str] | None = None
) -> DataFrame:
    """``rows`` with the columns of ``schema`` in its types; those they lack are null.

    With ``only``, just these columns.
    """
    known = {field.name: field.dataType for field in rows.schema.fields}
    columns = []
    for field_ in schema.fields:
        if only is not None and field_.name not in only:
            continue
        column = F.col(f"`{field_.name}`") if field_.name in known else F.lit(None)
        if known.get(field_.name) != field_.dataType:
            column = column.cast(field_.dataType)
        columns.append(column.alias(field_.name))
    return rows.select(*columns)


def plain_batch(batch: DataFrame, stored: list[str], required: list[str]) -> DataFrame:
    """``batch`` without reserved columns, known columns spelled as ``stored``.

    A batch that lacks a required column, or holds a null in the first of them, the
    record key, is refused.
    """
    sensitive = _case_sensitive(batch.sparkSession)

    def folded(name: str) -> str:
        return name if sensitive else name.lower()

    names = [c for c in batch.columns if folded(c) not in {folded(r) for r in RESERVED}]
    if len({folded(c) for c in names}) < len(names):
        raise ValueError(f"column names repeat: {names}")
    spelled = {folded(c): c for c in [*required, *stored]}
    rows = batch.select([F.col(f"`{c}`").alias(spelled.get(folded(c), c)) for c in names])
    missing = [c for c in required if c not in rows.columns]
    if missing:
        raise ValueError(f"the batch lacks {', '.join(missing)}")
    nulls = rows.where(F.col(f"`{required[0]}`").isNull()).count()
    if nulls:
        raise ValueError(f"{nulls} rows have no {required[0]}")
    return rows


def _case_sensitive(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.caseSensitive") == "true"


@dataclass(frozen=True)
class Commit:
    """``schema`` is the table's after the commit, which its files are written in."""

    commit_time: str
    operation: str
    schema: str = field(default="", compare=False, repr=False)
    folder: str = field(default="", compare=False, repr=False)

    @property
    def columns(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))


class VersionedTable:
    """A table at ``root`` whose rows are unique by ``key``.

    Instants are 17-digit texts. Within a batch the greatest ``precombine``
    wins; across commits the later commit does. Keys are unique table-wide, so
    a key whose ``partition`` value changes moves.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        first = self._history(LAST)[0]
        self.key, self.partition, self.precombine = first.key, first.partition, first.precombine
        self.generation = first.generation

    # -- writes ----------------------------------------------------------

    @classmethod
    def create(
        cls, df: DataFrame, root: str, key: str, partition: str, precombine: str, commit_time: str
    ) -> VersionedTable:
        """Make a table of the batch, replacing any table at ``root``.

        The rows go to a folder of their own, and the line that brings them into use
        comes last: if the batch fails, the table that was there stays.
        """
        _check_instant(commit_time)
        table = cls.__new__(cls)
        table.spark, table.root = df.sparkSession, root.rstrip("/")
        table.key, table.partition, table.precombine = key, partition, precombine
        table.generation = uuid.uuid4().hex
        number = table._last_number()
        df = plain_batch(df, [], [key, partition, precombine])
        rows = one_per_key(df, key, precombine)
        folder = table._write(rows.withColumn(DELETED, F.lit(False)), commit_time)
        table._append_line(commit_time, "create", _nullable(df.schema), number, folder)
        return table

    def upsert(self, df: DataFrame, commit_time: str, expected: str | None = None) -> None:
        """Insert new keys, replace known ones whole-row; may bring new columns.

        ``expected`` is the last commit that ``df`` was made from: if another has come since,
        nothing is written.
        """
        last = self._next(commit_time, expected)
        required = [self.key, self.partition, self.precombine]
        df = plain_batch(df, last.columns.names, required)
        schema = evolve(last.columns, _nullable(df.schema), _case_sensitive(self.spark))
        rows = as_schema(one_per_key(df, self.key, self.precombine), schema, df.columns)
        folder = self._write(rows.withColumn(DELETED, F.lit(False)), commit_time)
        self._append_line(commit_time, "upsert", schema, last.number, folder)

    def delete(self, df: DataFrame, commit_time: str, expected: str | None = None) -> None:
        """Delete the keys of the batch; its other columns do not matter.

        ``expected`` as for ``upsert``.
        """
        last = self._next(commit_time, expected)
        keys = plain_batch(df.select(self.key), [], [self.key])
        schema = evolve(last.columns, _nullable(keys.schema), _case_sensitive(self.spark))
        keys = as_schema(keys, schema, [self.key]).distinct()
        folder = self._write(keys.withColumn(DELETED, F.lit(True)), commit_time)
        self._append_line(commit_time, "delete", schema, last.number, folder)

    def compact(self) -> str:
        """Store the live rows of the latest commit as a starting point of reads.

        Reads then cost the size of the table and the commits since, not of the
        whole history. No commit goes away: every earlier instant stays readable.
        """
        last, commits = self._history(LAST)
        if Commit(last.commit_time, "compact") in commits:
            return last.commit_time
        rows = self.snapshot().drop(RECORD_KEY, PARTITION_PATH)
        folder = f"state/{uuid.uuid4().hex}"
        rows.write.parquet(self._path(folder))
        self._append_line(last.commit_time, "compact", last.columns, last.number, folder)
        return last.commit_time

    # -- reads -----------------------------------------------------------

    def snapshot(self) -> DataFrame:
        """Current rows, in the latest schema."""
        return self.as_of(LAST)

    def as_of(self, instant: str) -> DataFrame:
        """Rows as they were at ``instant`` (inclusive), in the schema of then."""
        _check_instant(instant)
        last, commits = self._history(instant)
        return self._described(self._live(last.columns, commits), last.columns)

    def changes(self, begin: str, end: str | None = None) -> DataFrame:
        """(change_type, key, before, after): how the rows at ``begin`` became those at ``end``.

        One row per key that differs between the two, deleted ones too, in the schema at
        ``end``. Only keys that a commit in between touched are looked for in the states;
        a key that was written and is as before gives no row.
        """
        _check_instant(begin)
        _check_instant(end or LAST)
        last, commits = self._history(end or LAST)
        schema = last.columns
        earlier = [c for c in commits if c.commit_time <= begin]
        between = [c for c in commits if c.commit_time > begin]
        touched = self._read_log(schema, between).select(self.key).distinct()
        touched = materialize(touched, "touched-keys")
        before = self._live(schema, earlier, touched).select(*schema.names)
        after = self._live(schema, commits, touched).select(*schema.names)
        return row_changes(before, after, self.key)

    def incremental(self, begin: str, end: str | None = None) -> DataFrame:
        """Rows written after ``begin`` up to ``end`` (inclusive), as at ``end``.

        In the latest schema. Opens only the commits in between: the latest
        version of a key is in there exactly when any version is.
        """
        _check_instant(begin)
        _check_instant(end or LAST)
        last, commits = self._history(LAST)
        between = [c for c in commits if begin < c.commit_time <= (end or LAST)]
        rows = self._read_log(last.columns, between)
        return self._described(live_rows(rows, self.key), last.columns)

    def commits(self) -> list[Commit]:
        """The timeline, oldest first."""
        return self._history(LAST)[1]

    # -- helpers ---------------------------------------------------------

    def _live(
        self, schema: StructType, commits: list[Commit], touched: DataFrame | None = None
    ) -> DataFrame:
        """Rows that are live after ``commits``, of all keys or of those ``touched``."""

        def own(rows: DataFrame) -> DataFrame:
            return rows if touched is None else lookup_join(rows, touched, [self.key], "inner")

        states = [c for c in commits if c.operation == "compact"]
        if not states:
            return live_rows(own(self._read_log(schema, commits)), self.key)
        newest = max(states, key=lambda c: c.commit_time)
        start = newest.commit_time
        stored = StructType([COMMIT_FIELD, *newest.columns.fields])
        state = self.spark.read.schema(stored).parquet(self._path(newest.folder))
        state = own(as_schema(state, StructType([COMMIT_FIELD, *schema.fields])))
        later = [c for c in commits if c.operation != "compact" and c.commit_time > start]
        if later:
            # the stored state loses the keys that changed since, and only these are ranked
            log = own(self._read_log(schema, later))
            changed = latest_versions(log, self.key, newest_first([COMMIT]))
            state = lookup_join(state, changed.select(self.key), [self.key], "left_anti")
            live = changed.where(~F.coalesce(F.col(DELETED), F.lit(False))).drop(DELETED)
            state = state.unionByName(live)
        return state

    def _history(self, end: str) -> tuple[_Line, list[Commit]]:
        """The last timeline line up to ``end``, and all commits up to there."""
        try:
            lines = self.spark.read.schema(TIMELINE).json(f"{self.root}/timeline")
        except AnalysisException as missing:
            raise NoSuchTable(self.root) from missing
        created = lines.where("operation = 'create'").agg(
            F.max(F.struct("number", "generation")).alias("newest")
        )
        newest = created.first()["newest"]
        if newest is None:
            raise NoSuchTable(self.root)
        lines = lines.where(F.col("generation") == newest["generation"])
        found = lines.where(F.col("commit_time") <= end).agg(
            F.max(F.struct("commit_time", "number", *TIMELINE.names[2:])).alias("last"),
            F.collect_list(F.struct("commit_time", "operation", "schema", "folder")).alias("commits"),
        )
        row = found.first()
        if row["last"] is None:
            raise NoSuchTable(f"{self.root} has no commit by {end}")
        commits = sorted((Commit(*c) for c in row["commits"]), key=lambda c: c.commit_time)
        return _Line(**row["last"].asDict()), commits

    def _last_number(self) -> int:
        try:
            lines = self.spark.read.schema(TIMELINE).json(f"{self.root}/timeline")
            return lines.agg(F.max("number")).first()[0] or 0
        except AnalysisException:
            return 0

    def _append_line(
        self, commit_time: str, operation: str, schema: StructType, after: int, folder: str
    ) -> None:
        """Bring a commit into use as the one that follows on line ``after``.

        The line's file is named by its number and moved into place only if no other has
        that name: of two writers that began from the same state, one has to start again.
        """
        names = (self.key, self.partition, self.precombine, self.generation, folder)
        values = (after + 1, commit_time, operation, schema.json(), *names)
        line = json.dumps(dict(zip(TIMELINE.names, values)))
        target = f"{self.root}/timeline/{after + 1:012d}.json"
        if not create_file(self.spark, target, line + "\n"):
            raise ConcurrentCommit(f"another commit came before {commit_time}; nothing changed")

    def _next(self, commit_time: str, expected: str | None = None) -> _Line:
        _check_instant(commit_time)
        last = self._history(LAST)[0]
        if expected is not None and last.commit_time != expected:
            raise ConcurrentCommit(f"{last.commit_time} has come after {expected}")
        if commit_time <= last.commit_time:
            raise ValueError(f"commit {commit_time} is not after {last.commit_time}")
        return last

    def _write(self, rows: DataFrame, commit_time: str) -> str:
        """Store a commit's rows in a folder of their own; gives the folder."""
        folder = f"log/{COMMIT}={commit_time}/{TRY}={uuid.uuid4().hex}"
        rows.write.parquet(self._path(folder))
        return folder

    def _path(self, folder: str) -> str:
        return f"{self.root}/{self.generation}/{folder}"

    def _read_log(self, schema: StructType, commits: list[Commit]) -> DataFrame:
        """Rows and tombstones of commits, as ``schema`` has them.

        Commits are read in the schema they were written in, those of one schema together.
        """
        target = StructType([*schema.fields, DELETED_FIELD, COMMIT_FIELD])
        alike: dict[str, list[Commit]] = {}
        for commit in commits:
            if commit.operation != "compact":
                alike.setdefault(commit.schema, []).append(commit)
        log = None
        for same in alike.values():
            stored = StructType([*same[0].columns.fields, DELETED_FIELD, COMMIT_FIELD])
            reader = self.spark.read.schema(stored).option("basePath", self._path("log"))
            rows = reader.parquet(*[self._path(c.folder) for c in same])
            rows = as_schema(rows, target)
            log = rows if log is None else log.union(rows)
        return self.spark.createDataFrame([], target) if log is None else log

    def _described(self, rows: DataFrame, schema: StructType) -> DataFrame:
        """Metadata columns first, the partition column last."""
        data = [name for name in schema.names if name != self.partition]
        return rows.select(
            COMMIT,
            F.col(self.key).cast("string").alias(RECORD_KEY),
            F.col(self.partition).cast("string").alias(PARTITION_PATH),
            *data,
            self.partition,
        )


@dataclass(frozen=True)
class _Line:
    commit_time: str
    operation: str
    schema: str
    key: str
    partition: str
    precombine: str
    generation: str
    folder: str
    number: int

    @property
    def columns(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))


def _nullable(schema: StructType) -> StructType:
    return StructType([StructField(f.name, f.dataType) for f in schema.fields])


def _check_instant(instant: str) -> None:
    if not INSTANT.fullmatch(instant):
        raise ValueError(f"an instant has 17 digits, not {instant!r}")
