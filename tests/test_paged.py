import time
from collections import Counter

import pytest

from martkit.operators.geo import enrich_points
from martkit.sources import paged
from martkit.sources.paged import fetch_kept, missing_ranges, page_ranges, paged_source
from martkit.sources.pages import fetch_pages, page_frame
from martkit.sources.polite import RateLimit, Retry, TokenBucket, polite

QUICK = Retry(attempts=3, first=0.001)


class Clock:
    def __init__(self):
        self.at = 0.0

    def now(self):
        return self.at

    def sleep(self, seconds):
        self.at += seconds


def test_a_bucket_bounds_the_rate():
    clock = Clock()
    bucket = TokenBucket(5, burst=3, now=clock.now, sleep=clock.sleep)
    times = []
    for _ in range(43):
        bucket.take()
        times.append(clock.at)
    assert times[:3] == [0, 0, 0]
    assert times[-1] == pytest.approx(40 / 5)
    # in no second more than the burst and the rate
    assert max(sum(t <= u < t + 1 for u in times) for t in times) <= 3 + 5
    clock.sleep(100)
    for _ in range(4):
        bucket.take()
    assert clock.at == pytest.approx(times[-1] + 100 + 0.2)
    with pytest.raises(ValueError):
        TokenBucket(0)


def test_statuses_are_tried_by_class():
    answers = {"busy": [429, 429, 200], "broken": [503, 500, 502, 200], "gone": [404, 200], "ok": [200]}
    asked = Counter()

    def client(point):
        asked[point] += 1
        return answers[point][asked[point] - 1], point

    waits = []
    call = polite(client, Retry(attempts=3), status=lambda a: a[0], sleep=waits.append)
    assert call("busy") == (200, "busy") and asked["busy"] == 3
    assert call("gone") == (404, "gone") and asked["gone"] == 1
    assert call("broken") == (502, "broken") and asked["broken"] == 3
    assert call("ok") == (200, "ok") and len(waits) == 4
    assert Retry(first=1, longest=5).wait(10, lambda: 1.0) == 5
    assert Retry(first=1).wait(3, lambda: 0.5) == 2


def test_exceptions_are_tried_and_then_raised():
    asked = []

    def client(page):
        asked.append(page)
        raise OSError("down")

    with pytest.raises(OSError):
        polite(client, Retry(attempts=4), sleep=lambda s: None)(1)
    assert len(asked) == 4
    with pytest.raises(OSError):
        polite(client)(1)
    assert len(asked) == 5


def test_enrichment_keeps_to_its_rate(spark, tmp_path):
    log = str(tmp_path / "calls")

    def connect():
        def client(point):
            with open(log, "a") as file:
                file.write(f"{time.time()} {point}\n")
            seen = open(log).read().count(f" {point}\n")
            return (429, "busy") if point == "p3" and seen == 1 else (404 if point == "p4" else 200, point)

        return client

    points = spark.createDataFrame([(f"p{i}",) for i in range(30)], "latlon string")
    found = enrich_points(points, connect, parallelism=3, retry=QUICK, limit=RateLimit(30))
    status = {row.latlon: row.status for row in found.collect()}
    assert status == {**{f"p{i}": 200 for i in range(30)}, "p4": 404}
    calls = [line.split() for line in open(log).read().splitlines()]
    asked = Counter(point for _, point in calls)
    assert asked["p3"] == 2 and asked["p4"] == 1 and asked.total() == 31
    times = sorted(float(at) for at, _ in calls)
    # each task may begin with one call at once, then 10 a second
    assert max(sum(t <= u < t + 0.5 for u in times) for t in times) <= 3 + 15 + 3


def flaky(fails):
    """Pages whose first ``fails`` tries raise."""

    def connect(secret):
        tried = Counter()

        def client(page):
            tried[page] += 1
            if page % 3 == 0 and tried[page] <= fails:
                raise OSError(f"page {page}")
            return f"{secret} {page}"

        return client

    return connect


def test_pages_are_fetched_again(spark):
    pages = page_frame(spark, 7, 2)
    found = fetch_pages(pages, flaky(2), "s", "empty", QUICK).collect()
    assert all(row.error is None for row in found)
    found = fetch_pages(pages, flaky(3), "s", "empty", QUICK).collect()
    assert {row.page for row in found if row.error} == {3, 6}


def test_a_source_of_pages(spark):
    spark.dataSource.register(paged_source("flaky_pages", flaky(2), "s", QUICK))
    read = spark.read.format("flaky_pages").option("pages", "1-7, 12").option("pagesPerTask", 3)
    frame = read.load()
    assert frame.rdd.getNumPartitions() == 4
    rows = {row.page: (row.sales_data, row.error) for row in frame.collect()}
    assert rows == {page: (f"s {page}", None) for page in (*range(1, 8), 12)}
    assert spark.read.format("flaky_pages").load().collect() == []


def test_pages_that_fail_for_good(spark):
    spark.dataSource.register(paged_source("broken_pages", flaky(99), "s", QUICK))
    read = spark.read.format("broken_pages").option("pages", "2-4")
    rows = {row.page: row for row in read.option("onError", "empty").load().collect()}
    assert rows[3].sales_data is None and rows[3].error == "OSError: page 3" and rows[2].error is None
    with pytest.raises(Exception, match="page 3"):
        read.option("onError", "raise").load().collect()
    with pytest.raises(Exception, match="onError"):
        read.option("onError", "?").load().collect()


def test_ranges(spark, monkeypatch):
    assert page_ranges("1-5, 9,") == [(1, 5), (9, 9)]
    with pytest.raises(ValueError):
        page_ranges("5-1")
    monkeypatch.setattr(paged, "SPAN", 10)
    present = spark.createDataFrame([(p,) for p in (3, 4, 4, 15, 30)], "page bigint")
    found = sorted(tuple(r) for r in missing_ranges(spark, 30, present).collect())
    assert found == [(1, 2), (5, 9), (10, 14), (16, 19), (20, 29)]


def test_a_second_run_asks_only_for_what_is_missing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(paged, "RANGES", 2)
    kept, log = str(tmp_path / "kept"), str(tmp_path / "asked")

    def connect(broken):
        def client(page):
            with open(log, "a") as file:
                file.write(f"{page}\n")
            if page in broken:
                raise OSError("down")
            return f"body {page}"

        return client

    def run(total, broken):
        open(log, "w").close()
        spark.dataSource.register(paged_source("kept_pages", connect, broken, Retry(attempts=1)))
        rows = fetch_kept(spark, "kept_pages", total, kept, pages_per_task=4).collect()
        return {r.page: r.sales_data for r in rows}, sorted(map(int, open(log).read().split()))

    rows, asked = run(12, {2, 5, 9})
    assert asked == list(range(1, 13))
    assert rows == {p: None if p in (2, 5, 9) else f"body {p}" for p in range(1, 13)}
    rows, asked = run(14, {9})
    assert asked == [2, 5, 9, 13, 14] and rows[2] == "body 2" and rows[9] is None
    rows, asked = run(14, set())
    assert asked == [9] and rows == {p: f"body {p}" for p in range(1, 15)}
    assert run(14, set()) == (rows, []) and run(3, set())[0].keys() == {1, 2, 3}


def test_many_pages_are_read_in_few_tasks_of_bounded_size(spark, tmp_path):
    kept, log = str(tmp_path / "kept"), str(tmp_path / "tasks")

    def connect(secret):
        # once a task
        with open(log, "a") as file:
            file.write("task\n")
        return lambda page: f"body {page}"

    spark.dataSource.register(paged_source("many_pages", connect, None, Retry(attempts=1)))
    rows = fetch_kept(spark, "many_pages", 20_000, kept).collect()
    assert sorted((r.page, r.sales_data) for r in rows) == [
        (p, f"body {p}") for p in range(1, 20_001)
    ]
    tasks = len(open(log).read().split())
    assert tasks <= paged.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    assert paged.task_size(spark, 10**9) == paged.MOST_PAGES_PER_TASK
    assert paged.task_size(spark, 10) == paged.PAGES_PER_TASK
