import json
import random
from collections import Counter
from pathlib import Path

import pytest
from plans import tree
from pyspark.sql import functions as F

from martkit.operators.geo import (
    containing_boxes,
    enrich_points,
    locate,
    parse_latlon,
    parse_response,
    response_box,
)

SAMPLE = "lat=48.20849&lon=16.37208"
RESPONSE = {
    "place_id": 90017,
    "licence": "open",
    "osm_type": "relation",
    "osm_id": 5501,
    "lat": "48.2083",
    "lon": "16.3725",
    "place_rank": 12,
    "importance": 0.61,
    "name": "Wien",
    "display_name": "Wien, Österreich",
    "address": {"city": "Wien", "country": "Österreich", "country_code": "at"},
    "boundingbox": ["48.1179", "48.3226", "16.1818", "16.5775"],
}


def test_f15_coordinates(spark):
    texts = [SAMPLE, "lat=abc&lon=", "lon=1e1&lat=-2", "", None, "lat=1&lat=2&lon=3", "xlat=1"]
    df = spark.createDataFrame([(text,) for text in texts], "latlon string")
    found = [(row.lat, row.lon) for row in parse_latlon(df).collect()]
    assert found == [
        (48.20849, 16.37208),
        (None, None), (-2.0, 10.0), (None, None), (None, None), (1.0, 3.0), (None, None),
    ]


class Asked:
    """A geocoder that notes every question in a folder."""

    def __init__(self, folder):
        self.folder = folder

    def __call__(self):
        def answer(point):
            name = f"{point.replace('&', '_')}-{random.random()}"
            Path(self.folder, name).touch()
            if point == SAMPLE:
                return 200, json.dumps(RESPONSE, ensure_ascii=False)
            return 404, json.dumps({"error": "Unable to geocode"})

        return answer


@pytest.mark.parametrize("bounds", [{}, {"max_rows": 0}])
def test_g1_every_point_is_asked_once(spark, tmp_path, bounds):
    points = [(i, SAMPLE if i % 3 else f"lat={i}&lon=0") for i in range(30)] + [(99, None)]
    df = spark.createDataFrame(points, "id int, latlon string").repartition(3)
    enriched = enrich_points(df, Asked(str(tmp_path)), parallelism=2, **bounds)
    assert enriched.columns == ["id", "latlon", "status", "body"]
    rows = enriched.collect()
    enriched.count()
    assert Counter(row.status for row in rows) == {200: 20, 404: 10, None: 1}
    assert len(list(tmp_path.iterdir())) == 11
    assert len(rows) == 31


def test_g2_t17_t18_responses(spark):
    bodies = [
        (200, json.dumps(RESPONSE, ensure_ascii=False)),
        (200, str({**RESPONSE, "name": None})),
        (404, json.dumps({"error": "Unable to geocode"})),
        (500, "<html>"),
        (None, None),
    ]
    df = spark.createDataFrame(bodies, "status int, body string")
    parsed = parse_response(df).transform(response_box).collect()
    assert [(row.status, row.malformed) for row in parsed] == [
        (200, False), (200, True), (404, False), (500, True), (None, False),
    ]
    place = parsed[0].place
    assert (place.place_id, place.name, place.address.country_code) == (90017, "Wien", "at")
    assert (parsed[0].south, parsed[0].east) == (48.1179, 16.5775)
    assert parsed[1].place is None and parsed[2].place.place_id is None


BOXES = "id int, name string, south double, north double, west double, east double"
WIEN = (1, "Wien", 48.1179, 48.3226, 16.1818, 16.5775)
AROUND = (2, "Österreich", 46.0, 49.0, 9.0, 17.5)

SMALL = {"max_rows": 0}


@pytest.mark.parametrize("bounds", [{}, SMALL])
def test_g3_smallest_box_wins(spark, bounds):
    places = spark.createDataFrame([AROUND, WIEN], BOXES)
    texts = [(SAMPLE,), ("lat=47&lon=13",), ("lat=0&lon=0",), ("lat=abc&lon=",), ("lat=99&lon=0",)]
    points = parse_latlon(spark.createDataFrame(texts, "latlon string"))
    found = locate(points, places, "id", ["id", "name"], **bounds)
    assert found.columns == ["latlon", "lat", "lon", "id", "name"]
    assert {row.latlon: row.id for row in found.collect()} == {
        SAMPLE: 1, "lat=47&lon=13": 2, "lat=0&lon=0": None, "lat=abc&lon=": None, "lat=99&lon=0": None,
    }


def inside(point, box):
    return box[2] <= point[1] <= box[3] and box[4] <= point[2] <= box[5]


def scatter(seed):
    """Boxes of all sizes, some touching edges or turned around; half the points equal."""
    rng = random.Random(seed)
    boxes = [(0, "globe", -90.0, 90.0, -180.0, 180.0), (1, "beyond", 60.0, 120.0, 100.0, 300.0)]
    for i in range(2, 80):
        size = 10 ** rng.uniform(-4, 2)
        south, west = rng.uniform(-90, 90), rng.uniform(-180, 180)
        boxes.append((i, f"b{i}", south, south + size, west, west + size * rng.uniform(0.1, 2)))
    boxes += [(80, "point", 10.0, 10.0, 20.0, 20.0), (81, "turned", 5.0, 1.0, 0.0, 9.0)]
    boxes += [(82, "nan", float("nan"), 1.0, 0.0, 1.0), (83, "none", None, 1.0, 0.0, 1.0)]
    points = [(0, 10.0, 20.0), (1, 90.0, 180.0), (2, -90.0, -180.0), (3, float("nan"), 0.0)]
    points += [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(4, 120)]
    for i, box in enumerate(boxes[2:80]):  # corners and middles
        points.append((200 + i, min(box[3], 90.0), box[4]))
        points.append((300 + i, (box[2] + box[3]) / 2, (box[4] + box[5]) / 2))
    points += [(i, 47.0, 13.0) for i in range(1000, 1300)]
    return boxes, [p for p in points if not abs(p[1]) > 90 and not abs(p[2]) > 180]


@pytest.mark.parametrize("bounds", [{}, SMALL])
def test_boxes_equal_brute_force(spark, bounds):
    boxes, points = scatter(7)
    frame = spark.createDataFrame(points, "p int, lat double, lon double")
    places = spark.createDataFrame(boxes, BOXES)
    sound = [box for box in boxes if None not in box and box[2] <= box[3]]
    want = {(p[0], b[0]) for p in points for b in sound if inside(p, b)}
    pairs = containing_boxes(frame, places, ["id"], **bounds).select("p", "id").collect()
    assert len(pairs) == len(want) and set(map(tuple, pairs)) == want

    area = {b[0]: (b[3] - b[2]) * (b[5] - b[4]) for b in sound}
    best = {p[0]: None for p in points}
    for p, b in sorted(want, key=lambda pair: (area[pair[1]], pair[1]), reverse=True):
        best[p] = b
    found = locate(frame, places, "id", ["id"], **bounds).collect()
    assert len(found) == len(points)
    assert {row.p: row.id for row in found} == best


def test_ties_go_to_the_least(spark):
    places = spark.createDataFrame([(2, "b", 0.0, 1.0, 0.0, 1.0), (1, "c", 0.0, 1.0, 0.0, 1.0)], BOXES)
    points = spark.createDataFrame([(0.5, 0.5)], "lat double, lon double")
    assert locate(points, places, "id", ["name"], **SMALL).first().name == "c"
    assert locate(points, places, "name", ["name", "id"]).first().name == "b"


def test_no_boxes_at_all(spark):
    points = spark.createDataFrame([(0.5, 0.5)], "lat double, lon double")
    places = spark.createDataFrame([], BOXES)
    assert locate(points, places, "id", ["id"]).first().id is None


def test_points_pass_without_a_shuffle(spark):
    points = spark.range(1000).select((F.col("id") % 90).cast("double").alias("lat"), F.col("id").cast("double").alias("lon"))
    places = spark.createDataFrame([AROUND, WIEN], BOXES)
    text = tree(locate(points, places, "id", ["id"]))
    assert "NestedLoop" not in text and "Cartesian" not in text
    # the only exchange besides broadcasts groups the boxes by cell
    assert text.count("Exchange hashpartitioning(cell") == text.count("Exchange hashpartitioning")
    shuffled = tree(locate(points, places, "id", ["id"], **SMALL))
    assert "NestedLoop" not in shuffled and "Cartesian" not in shuffled


def test_all_levels_share_one_broadcast(spark):
    boxes, points = scatter(7)
    frame = spark.createDataFrame(points, "p int, lat double, lon double")
    located = locate(frame, spark.createDataFrame(boxes, BOXES), "id", ["id"])
    located.collect()
    ran = tree(located).split("== Initial Plan ==")[0]
    assert ran.count("BroadcastHashJoin") - ran.count("ReusedExchange") == 1


def brute_force_box(lat, lon, boxes):
    def inside(south, north, west, east):
        within = west <= lon <= east if west <= east else lon >= west or lon <= east
        return south <= lat <= north and within

    def area(south, north, west, east):
        return (north - south) * ((east - west) % 360)

    hits = [(area(*b), i) for i, b in enumerate(boxes) if inside(*b)]
    return [i for _, i in sorted(hits)]


def test_boxes_across_the_date_line(spark):
    boxes = [
        (-20.0, 10.0, 170.0, -170.0), (-90.0, 90.0, 100.0, -100.0), (-5.0, 5.0, 179.5, -179.5),
        (0.0, 20.0, -180.0, -175.0), (0.0, 20.0, 175.0, 180.0), (-90.0, 90.0, 10.0, -10.0),
        (0.0, 1.0, 180.0, -180.0), (-30.0, 30.0, 150.0, 180.0),
    ]
    places = spark.createDataFrame(
        [(i, *b) for i, b in enumerate(boxes)], "id int, south double, north double, west double, east double"
    )
    spots = [
        (lat, lon)
        for lat in (-90.0, -5.0, 0.0, 0.5, 9.0, 25.0)
        for lon in (-180.0, -179.6, -179.5, -176.0, -170.0, -99.0, -10.0, 0.0, 10.0, 120.0, 172.0, 179.9, 180.0)
    ]
    points = spark.createDataFrame(spots, "lat double, lon double")
    found = locate(points, places, "id", ["id"], date_line=True)
    expected = {(lat, lon): (brute_force_box(lat, lon, boxes) or [None])[0] for lat, lon in spots}
    assert {(r.lat, r.lon): r.id for r in found.collect()} == expected
    every = containing_boxes(points, places, ["id"], date_line=True)
    listed = sorted((r.lat, r.lon, r.id) for r in every.collect())
    assert listed == sorted((*p, i) for p in spots for i in brute_force_box(*p, boxes))
    # without the option such boxes hold no point, as before
    plain = {r.id for r in containing_boxes(points, places, ["id"]).collect()}
    assert plain == {3, 4, 7}
