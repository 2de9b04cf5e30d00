"""Reverse geocoding: by an outside service, or by a table of bounding boxes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from martkit.functions.geo import (
    cell_column,
    cell_key,
    cell_row,
    coordinate,
    grid_level,
    level_pair,
    on_globe,
)
from martkit.operators.joins import (
    BROADCAST_BYTES,
    BROADCAST_ROWS,
    WEIGHT,
    lookup_join,
)
from martkit.schemas import GEO_RESPONSE
from martkit.session import materialize
from martkit.sources.batches import frames
from martkit.sources.polite import RateLimit, Retry, polite

BOX = ("south", "north", "west", "east")

CORRUPT = "_corrupt_record"


def parse_latlon(df: DataFrame, column: str = "latlon") -> DataFrame:
    """Add ``lat`` and ``lon``; null where the text is malformed."""
    text = F.col(column)
    return df.withColumns({"lat": coordinate(text, "lat"), "lon": coordinate(text, "lon")})


# -- by an outside service -------------------------------------------------


def enrich_points(
    df: DataFrame,
    connect: Callable[[], Callable[[str], tuple[int, str]]],
    column: str = "latlon",
    parallelism: int | None = None,
    max_rows: int = BROADCAST_ROWS,
    on_error: str = "raise",
    kept: str | None = None,
    retry: Retry | None = None,
    limit: RateLimit | None = None,
) -> DataFrame:
    """Add ``status`` and ``body``, the service's answer for each point.

    ``connect`` runs once per task and gives a client from point to (status,
    body). Every distinct point is asked once, by at most ``parallelism`` tasks
    at a time, and the answers are stored before use, so neither repeated points
    nor a re-run of later steps ask again (a task that Spark runs twice asks twice).
    With ``on_error="report"`` a failing call gives a null status and the error as the
    body, and the others go on. ``retry`` says which statuses are asked again, and how
    often; ``limit`` bounds the requests a second of all tasks together. In the folder ``kept`` answers outlast the job: a later
    run adds to it, and asks only for points it has no answer for.
    """
    if on_error not in ("raise", "report"):
        raise ValueError("on_error is 'raise' or 'report'")

    def answer(client, point):
        try:
            return client(point)
        except Exception as error:
            if on_error == "raise":
                raise
            return None, f"{type(error).__name__}: {error}"[:1000]

    tasks = parallelism or df.sparkSession.sparkContext.defaultParallelism

    def ask(batches):
        bucket = limit.bucket(tasks) if limit else None
        client = polite(connect(), retry, bucket, status=lambda answer: answer[0])
        for batch in batches:
            answers = ((point, *answer(client, point)) for point in batch[column])
            for frame in frames(answers, [column, "status", "body"]):
                yield frame.astype({"status": "Int32"})

    schema = StructType(
        [
            StructField(column, StringType()),
            StructField("status", IntegerType()),
            StructField("body", StringType()),
        ]
    )
    points = df.groupBy(column).agg(F.count(F.lit(1)).alias(WEIGHT)).dropna(subset=[column])
    points = materialize(points, "points")
    open_points = points.select(column)
    known = _kept_answers(df.sparkSession, kept, schema) if kept else None
    if known is not None:
        open_points = lookup_join(open_points, known.select(column), [column], "left_anti")
    answers = materialize(open_points.repartition(tasks).mapInPandas(ask, schema), "answers")
    if kept:
        answers.where(F.col("status").isNotNull()).write.mode("append").parquet(kept)
    if known is not None:
        answers = answers.unionByName(known)
    return lookup_join(df, answers, [column], weights=points, max_rows=max_rows)


def _kept_answers(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """Answers of earlier runs, one for each point."""
    try:
        stored = spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    # stored once more, as the folder grows while this run reads it
    return materialize(stored.dropDuplicates([schema.names[0]]), "kept-answers")


def parse_response(df: DataFrame, column: str = "body") -> DataFrame:
    """Add ``place``, the parsed answer, and ``malformed``.

    Only real JSON passes: text with single-quoted names, such as a printed
    dictionary, is malformed.
    """
    schema = StructType([*GEO_RESPONSE.fields, StructField(CORRUPT, StringType())])
    options = {"columnNameOfCorruptRecord": CORRUPT, "allowSingleQuotes": "false"}
    answer = F.from_json(column, schema, options)
    broken = F.col("__answer").isNull() | F.col(f"__answer.{CORRUPT}").isNotNull()
    place = F.struct(*[F.col(f"__answer.{name}") for name in GEO_RESPONSE.names])
    parsed = df.withColumn("__answer", answer)
    malformed = F.col(column).isNotNull() & broken
    return parsed.withColumns(
        {"place": F.when(~broken, place), "malformed": malformed}
    ).drop("__answer")


def response_box(df: DataFrame, column: str = "place") -> DataFrame:
    """Add the bounds of a parsed answer as doubles."""
    bounds = F.col(f"{column}.boundingbox")
    return df.withColumns(
        {name: F.get(bounds, F.lit(i)).try_cast("double") for i, name in enumerate(BOX)}
    )


# -- by a table of boxes ---------------------------------------------------
#
# A box is filed under the grid cells it touches. Height and width each choose a level
# whose cells are just no smaller, so a box touches a handful of cells whatever its size
# or shape, and a long thin one is not filed with all points along it. A point looks into
# one cell for each pair of levels in use. Both sides compute cells with the same monotone
# expressions, so a containing box is always found.

CELL = "__cell"
PLACE = "__place"
BEST = "__best"


def locate(
    points: DataFrame,
    places: DataFrame,
    tie: str,
    payload: list[str],
    max_rows: int = BROADCAST_ROWS // 10,
    max_bytes: int = BROADCAST_BYTES // 4,
    date_line: bool = False,
) -> DataFrame:
    """Add ``payload`` of the smallest box around each point (``lat``, ``lon``).

    Equal areas are decided by the least ``tie``, which must be a payload
    column; points in no box get nulls. Each distinct point is located once. With
    ``date_line`` a box whose west is greater than its east lies across the 180th
    meridian; otherwise such a box holds no point.
    """
    order = [tie, *[c for c in payload if c != tie]]
    boxes, levels = _boxes(places, order, date_line)
    valid = points.where(on_globe(F.col("lat"), F.col("lon")))
    distinct = valid.groupBy("lat", "lon").agg(F.count(F.lit(1)).alias(WEIGHT))
    distinct = materialize(distinct, "points")
    hits = _hits(distinct.select("lat", "lon"), boxes, levels, max_rows, max_bytes)
    best = materialize(hits.groupBy("lat", "lon").agg(F.min(PLACE).alias(BEST)), "located")
    located = lookup_join(points, best, ["lat", "lon"], weights=distinct, max_rows=max_rows)
    return located.select(
        *[F.col(f"`{c}`") for c in points.columns],
        *[F.col(f"{BEST}.{c}").alias(c) for c in payload],
    )


def containing_boxes(
    points: DataFrame,
    places: DataFrame,
    payload: list[str],
    max_rows: int = BROADCAST_ROWS // 10,
    max_bytes: int = BROADCAST_BYTES // 4,
    date_line: bool = False,
) -> DataFrame:
    """Points joined with every box around them; a range join. ``date_line`` as in ``locate``."""
    boxes, levels = _boxes(places, payload, date_line)
    hits = _hits(points, boxes, levels, max_rows, max_bytes)
    return hits.select(
        *[F.col(f"`{c}`") for c in points.columns],
        *[F.col(f"{PLACE}.{c}").alias(c) for c in payload],
    )


AREA = "__area"


def _parts(boxed: DataFrame, date_line: bool) -> DataFrame:
    """The boxes with their areas; one across the date line as its two parts.

    Both parts carry the area of the whole, so a box is not taken for a smaller one. The
    meridian itself belongs to both, as 180 to one and as -180 to the other, so a point is
    in one of them at most.
    """
    south, north, west, east = (F.col(name) for name in BOX)
    height = north - south
    if not date_line:
        return boxed.withColumn(AREA, height * (east - west))
    across = (west > east) & (west <= 180) & (east >= -180)
    whole = F.array(F.struct(west.alias("west"), east.alias("east")))
    halves = F.array(
        F.struct(west.alias("west"), F.lit(180.0).alias("east")),
        F.struct(F.lit(-180.0).alias("west"), east.alias("east")),
    )
    turned = F.when(across, F.lit(360.0)).otherwise(F.lit(0.0))
    split = boxed.withColumn(AREA, height * (east - west + turned))
    split = split.withColumn("__part", F.explode(F.when(across, halves).otherwise(whole)))
    bounds = {"west": F.col("__part.west"), "east": F.col("__part.east")}
    return split.withColumns(bounds).drop("__part")


def _boxes(
    places: DataFrame, order: list[str], date_line: bool = False
) -> tuple[DataFrame, list[int]]:
    """(cell, place) for every cell a valid box touches, and the pairs of levels in use.

    A box without bounds, or with bounds the wrong way round, contains no point.
    """
    boxed = places.withColumns({name: F.col(name).cast("double") for name in BOX})
    boxed = _parts(boxed, date_line)
    south, north, west, east = (F.col(name) for name in BOX)
    # NaN is the greatest double, so these tests turn it away as well
    valid = boxed.where((south <= north) & (west <= east))
    valid = valid.where((south <= 90) & (north >= -90) & (west <= 180) & (east >= -180))
    valid = valid.where(~F.isnan(north) & ~F.isnan(east))
    place = F.struct(F.col(AREA).alias("area"), *order)
    bounds = [f"__{name}" for name in BOX]
    # cells of the part that lies on the globe; the test uses the whole box
    bottom, top = F.greatest(south, F.lit(-90.0)), F.least(north, F.lit(90.0))
    left, right = F.greatest(west, F.lit(-180.0)), F.least(east, F.lit(180.0))
    row_level, column_level = F.col("row_level"), F.col("column_level")
    leveled = valid.select(
        place.alias(PLACE),
        *[F.col(name).alias(bound) for name, bound in zip(BOX, bounds)],
        bottom.alias("bottom"),
        top.alias("top"),
        left.alias("left"),
        right.alias("right"),
        grid_level(top - bottom).alias("row_level"),
        grid_level(right - left).alias("column_level"),
    ).withColumn("pair", level_pair(row_level, column_level))
    rows = F.sequence(cell_row(F.col("bottom"), row_level), cell_row(F.col("top"), row_level))
    columns = F.sequence(
        cell_column(F.col("left"), column_level), cell_column(F.col("right"), column_level)
    )
    boxes = (
        leveled.withColumn("row", F.explode(rows))
        .withColumn("column", F.explode(columns))
        .select(
            cell_key(F.col("pair"), F.col("row"), F.col("column")).alias(CELL),
            "pair",
            PLACE,
            *bounds,
        )
    )
    boxes = materialize(boxes, "boxes")
    pairs = [row[0] for row in boxes.select("pair").distinct().collect()]
    return boxes.drop("pair"), sorted(pairs)


def _point_cell(pair: int) -> Column:
    """The point's cell at a pair of levels, null off the globe."""
    lat, lon = F.col("lat"), F.col("lon")
    row, column = cell_row(lat, F.lit(pair // 32)), cell_column(lon, F.lit(pair % 32))
    return F.when(on_globe(lat, lon), cell_key(F.lit(pair), row, column))


def _hits(
    points: DataFrame, boxes: DataFrame, pairs: list[int], max_rows: int, max_bytes: int
) -> DataFrame:
    """``points`` with ``__place`` for every box around them, joined by cell.

    Boxes within the bounds are broadcast; beyond, busy cells are salted by
    ``lookup_join``. The exact test is a condition of the join, so only true hits go on.
    """
    cells = [_point_cell(pair) for pair in pairs] or [F.lit(None).cast("bigint")]
    keyed = points.withColumn(CELL, F.explode(F.array(*cells)))
    found = lookup_join(keyed, boxes, [CELL], "inner", max_rows=max_rows, max_bytes=max_bytes)
    inside = F.col("lat").between(F.col("__south"), F.col("__north"))
    inside &= F.col("lon").between(F.col("__west"), F.col("__east"))
    return found.where(inside)
