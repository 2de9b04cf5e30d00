"""A paged API as a source of ``spark.read``: ranges of pages are its partitions.

    source = paged_source("sales_api", connect, secret=token, retry=Retry())
    spark.dataSource.register(source)
    spark.read.format("sales_api").option("pages", "1-500").load()

:func:`fetch_kept` reads through such a source and keeps what came, so a run that is made
again asks only for pages that are missing.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import batched

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from martkit.operators.joins import lookup_join
from martkit.schemas import FETCHED
from martkit.session import materialize
from martkit.sources.pages import Connect
from martkit.sources.polite import RateLimit, Retry, polite

# Pages of a partition unless the option ``pagesPerTask`` says otherwise.
PAGES_PER_TASK = 100

# Ranges named in one read, and the span of pages within which they are found.
RANGES = 10_000
SPAN = 100_000

# Pages of a task of :func:`fetch_kept` at most, and its tasks for each core when fewer fill
# them: a task has a fixed cost, many times that of a hundred pages.
MOST_PAGES_PER_TASK = 5_000
TASKS_PER_CORE = 4


class PageRange(InputPartition):
    """Pages from ``first`` to ``last``, both included."""

    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


def page_ranges(text: str) -> list[tuple[int, int]]:
    """The ranges of a text such as "1-5,9"."""
    ranges = []
    for part in filter(None, (p.strip() for p in text.split(","))):
        first, _, last = part.partition("-")
        ranges.append((int(first), int(last or first)))
        if ranges[-1][0] > ranges[-1][1]:
            raise ValueError(f"a range ends before it begins: {part}")
    return ranges


def paged_source(
    name: str,
    connect: Connect,
    secret: object = None,
    retry: Retry | None = Retry(),
    limit: RateLimit | None = None,
) -> type[DataSource]:
    """A source, to be registered under ``name``, that reads pages through a client.

    ``connect`` gives each task a client from page number to body. Options: ``pages``, the
    ranges to read; ``pagesPerTask``; ``onError``, "raise" (which fails the task, and
    Spark tries it again) or "empty" (the page has no body but an error). ``limit`` is for
    all partitions together; the share of each is the same.
    """

    class Reader(DataSourceReader):
        def __init__(self, options: dict[str, str]):
            # option names come in lower case
            self.ranges = page_ranges(options.get("pages", ""))
            self.size = int(options.get("pagespertask", PAGES_PER_TASK))
            self.on_error = options.get("onerror", "raise")
            if self.size < 1 or self.on_error not in ("raise", "empty"):
                raise ValueError("pagesPerTask is at least 1, onError is 'raise' or 'empty'")
            self.parts = sum(-(-(last - first + 1) // self.size) for first, last in self.ranges)

        def partitions(self) -> list[PageRange]:
            parts = [
                PageRange(begin, min(begin + self.size - 1, last))
                for first, last in self.ranges
                for begin in range(first, last + 1, self.size)
            ]
            # Spark reads a source without partitions as one unnamed partition
            return parts or [PageRange(1, 0)]

        def read(self, partition: PageRange) -> Iterator[tuple]:
            bucket = limit.bucket(self.parts) if limit else None
            client = polite(connect(secret), retry, bucket)
            for page in range(partition.first, partition.last + 1):
                try:
                    yield page, client(page), None
                except Exception as error:
                    if self.on_error == "raise":
                        raise
                    yield page, None, f"{type(error).__name__}: {error}"[:1000]

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> StructType:
            return FETCHED

        def reader(self, schema: StructType) -> DataSourceReader:
            return Reader({key.lower(): value for key, value in self.options.items()})

    return Source


def missing_ranges(spark: SparkSession, total_pages: int, present: DataFrame) -> DataFrame:
    """(first, last): the runs of pages from 1 to ``total_pages`` that are not ``present``.

    Runs are cut at multiples of SPAN, so no task sees all pages.
    """
    pages = spark.range(1, total_pages + 1).toDF("page")
    open_pages = lookup_join(pages, present.select("page").distinct(), ["page"], "left_anti")
    span = F.floor(F.col("page") / SPAN)
    order = Window.partitionBy("span").orderBy("page")
    runs = open_pages.withColumn("span", span).withColumn(
        "run", F.col("page") - F.row_number().over(order)
    )
    found = runs.groupBy("span", "run").agg(F.min("page").alias("first"), F.max("page").alias("last"))
    return found.select("first", "last")


def fetch_kept(
    spark: SparkSession,
    source: str,
    total_pages: int,
    kept: str,
    on_error: str = "empty",
    pages_per_task: int | None = None,
) -> DataFrame:
    """The bodies of all pages, one row each, asking ``source`` only for those not in ``kept``.

    What comes is added to the folder before it is used. Pages that fail have no body but an
    error; they are not kept, so the next run asks for them again. Without ``pages_per_task``
    a read gives each core a few tasks, of PAGES_PER_TASK to MOST_PAGES_PER_TASK pages.
    """
    known = _kept(spark, kept)
    ranges = materialize(missing_ranges(spark, total_pages, known), "missing-pages")
    failed = None
    for lot in batched(ranges.orderBy("first").toLocalIterator(), RANGES):
        wanted = ",".join(f"{first}-{last}" for first, last in lot)
        size = pages_per_task or task_size(spark, sum(last - first + 1 for first, last in lot))
        read = spark.read.format(source).option("pages", wanted).option("onError", on_error)
        # stored once: both uses of it see the same answers
        came = materialize(read.option("pagesPerTask", size).load(), "came-pages")
        came.where(F.col("error").isNull()).write.mode("append").parquet(kept)
        errors = came.where(F.col("error").isNotNull())
        failed = errors if failed is None else failed.unionByName(errors)
    whole = _kept(spark, kept).where(F.col("page") <= total_pages)
    return whole if failed is None else whole.unionByName(failed)


def task_size(spark: SparkSession, pages: int) -> int:
    """Pages of a task when ``pages`` are read: a few tasks a core, none too small or large."""
    tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    return max(PAGES_PER_TASK, min(MOST_PAGES_PER_TASK, -(-pages // tasks)))


def _kept(spark: SparkSession, kept: str) -> DataFrame:
    try:
        stored = spark.read.schema(FETCHED).parquet(kept)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FETCHED)
    # a run that broke off after it had added pages may have left some twice
    return stored.dropDuplicates(["page"])
