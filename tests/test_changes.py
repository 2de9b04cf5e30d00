from decimal import Decimal

import pytest
from plans import plan
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    TimestampNTZType,
)

from martkit.operators import maintained
from martkit.operators.changes import flat, row_changes
from martkit.operators.maintained import MaintainedRollup, WindowMismatch, group_totals
from martkit.operators.types import common_type
from martkit.operators.versioned import ConcurrentCommit, VersionedTable, evolve

SCHEMA = "id string, day string, amount double, at int"
T = ["20240101000000000", "20240102000000000", "20240103000000000", "20240104000000000"]


def batch(spark, *rows, schema=SCHEMA):
    return spark.createDataFrame(list(rows), schema)


@pytest.fixture
def table(spark, tmp_path):
    """Four commits: four rows, then an update, a move, a rewrite and an insert, then deletes."""
    made = VersionedTable.create(
        batch(spark, ("a", "d1", 1.0, 1), ("b", "d1", 2.0, 1), ("c", "d2", None, 1), ("e", "d2", 5.5, 1)),
        str(tmp_path / "table"), "id", "day", "at", T[0],
    )
    made.upsert(
        batch(spark, ("a", "d1", 9.0, 2), ("b", "d3", 2.0, 2), ("c", "d2", None, 1), ("f", "d1", 4.0, 2)),
        T[1],
    )
    made.delete(batch(spark, ("e", None, None, None), ("nobody", None, None, None)), T[2])
    return made


def feed(frame):
    rows = {}
    for row in frame.collect():
        images = [side and (side.day, side.amount) for side in (row.before, row.after)]
        rows[row.id] = (row.change_type, *images)
    return rows


def test_changes_carry_images(table):
    first = {
        "a": ("update", ("d1", 1.0), ("d1", 9.0)),
        "b": ("update", ("d1", 2.0), ("d3", 2.0)),
        "f": ("insert", None, ("d1", 4.0)),
    }
    # c was written again as it was
    assert feed(table.changes(T[0], T[1])) == first
    gone = {"e": ("delete", ("d2", 5.5), None)}
    assert feed(table.changes(T[1])) == gone
    assert feed(table.changes(T[0])) == {**first, **gone}
    assert feed(table.changes(T[2])) == {}
    born = feed(table.changes("20230101000000000", T[0]))
    assert {kind for kind, *_ in born.values()} == {"insert"} and len(born) == 4


def test_a_key_that_comes_and_goes_between_is_no_change(spark, table):
    table.upsert(batch(spark, ("g", "d9", 1.0, 3)), T[3])
    table.delete(batch(spark, ("g", None, None, None)), "20240105000000000")
    assert feed(table.changes(T[2])) == {}
    assert feed(table.changes(T[2], T[3])) == {"g": ("insert", None, ("d9", 1.0))}


def test_changes_over_a_compacted_state_and_new_columns(spark, table):
    table.compact()
    wider = batch(spark, ("a", "d1", 9.0, 4, "x"), schema=SCHEMA + ", note string")
    table.upsert(wider, T[3])
    (row,) = table.changes(T[2]).collect()
    assert row.change_type == "update"
    assert row.before.note is None and row.after.note == "x"
    assert len(feed(table.changes(T[0]))) == 4


def test_only_touched_keys_are_ranked(spark, tmp_path):
    rows = spark.range(2000).selectExpr("cast(id as string) id", "'d' day", "1d amount", "1 at")
    made = VersionedTable.create(rows, str(tmp_path / "t"), "id", "day", "at", T[0])
    made.upsert(batch(spark, ("5", "d", 3.0, 2)), T[1])
    changes = made.changes(T[0])
    assert feed(changes) == {"5": ("update", ("d", 1.0), ("d", 3.0))}
    text = plan(changes, "simple")
    # the touched keys are broadcast to the logs before any shuffle of theirs
    assert text.count("BroadcastHashJoin") >= 2 or text.count("BroadcastExchange") >= 2


def test_nulls_are_equal_and_maps_are_refused(spark):
    old = spark.createDataFrame([(1, None), (2, "x")], "k int, v string")
    new = spark.createDataFrame([(1, None), (2, None)], "k int, v string")
    (row,) = flat(row_changes(old, new, "k")).collect()
    assert tuple(row) == ("update", 2, 2, "x", 2, None)
    with pytest.raises(ValueError, match="map"):
        row_changes(old.withColumn("m", F.create_map(F.lit(1), F.lit(2))), new, "k")


# -- roll-ups ------------------------------------------------------------------


def totals(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


def anew(table, keys):
    rows = group_totals(table.snapshot(), keys, "amount")
    total = F.when(F.col("amounts") > 0, F.col("total"))
    return totals(rows.select(*keys, total.alias("total"), "rows"))


@pytest.mark.parametrize("keys", [["day"], ["day", "at"]])
def test_a_maintained_rollup_equals_one_computed_anew(spark, table, tmp_path, keys):
    rollup = MaintainedRollup(spark, str(tmp_path / "rollup"), keys, "amount")
    rollup.start(table.as_of(T[0]), T[0])
    assert rollup.follow(table) == T[2]
    assert totals(rollup.read()) == anew(table, keys)
    assert rollup.follow(table) == T[2]

    table.delete(batch(spark, ("b", None, None, None), ("c", None, None, None)), T[3])
    table.upsert(batch(spark, ("n", None, 7.25, 9), ("f", None, None, 9)), "20240105000000000")
    rollup.follow(table)
    assert totals(rollup.read()) == anew(table, keys)
    table.delete(batch(spark, ("n", None, None, None)), "20240106000000000")
    rollup.follow(table)
    assert totals(rollup.read()) == anew(table, keys)


def test_amounts_add_up_exactly(spark, tmp_path):
    rows = spark.range(1000).selectExpr("cast(id as string) id", "'d' day", "0.1d amount", "1 at")
    made = VersionedTable.create(rows, str(tmp_path / "t"), "id", "day", "at", T[0])
    rollup = MaintainedRollup(spark, str(tmp_path / "rollup"), ["day"], "amount")
    rollup.start(made.snapshot(), T[0])
    made.delete(rows.where("id < 999"), T[1])
    rollup.follow(made)
    assert totals(rollup.read()) == [("d", Decimal("0.1000"), 1)]


def test_a_window_that_broke_off_is_applied_once(spark, table, tmp_path, monkeypatch):
    rollup = MaintainedRollup(spark, str(tmp_path / "rollup"), ["day"], "amount")
    rollup.start(table.as_of(T[0]), T[0])

    # all days are replaced, but the window is not noted as done
    note = MaintainedRollup._note

    def breaks(self, number, begin, end, done):
        if done:
            raise KeyboardInterrupt
        note(self, number, begin, end, done)

    monkeypatch.setattr(MaintainedRollup, "_note", breaks)
    with pytest.raises(KeyboardInterrupt):
        rollup.apply(table.changes(T[0], T[1]), T[0], T[1])
    monkeypatch.undo()
    assert rollup.unfinished() == (T[0], T[1]) and rollup.applied() == T[0]
    with pytest.raises(WindowMismatch):
        rollup.apply(table.changes(T[0], T[2]), T[0], T[2])
    assert rollup.follow(table) == T[2]
    assert totals(rollup.read()) == anew(table, ["day"])


def test_windows_follow_on(spark, table, tmp_path):
    rollup = MaintainedRollup(spark, str(tmp_path / "rollup"), ["day"], "amount")
    with pytest.raises(WindowMismatch, match="no roll-up"):
        rollup.applied()
    rollup.start(table.as_of(T[0]), T[0])
    with pytest.raises(WindowMismatch):
        rollup.apply(table.changes(T[1], T[2]), T[1], T[2])


def test_only_touched_days_are_read(spark, table, tmp_path):
    rollup = MaintainedRollup(spark, str(tmp_path / "rollup"), ["day"], "amount")
    rollup.start(table.as_of(T[0]), T[0])
    text = plan(rollup.of_days(["d1", None]))
    assert "PartitionFilters: [(" in text and "Filter (" not in text, text
    assert {row.day for row in rollup.of_days(["d1", None]).collect()} == {"d1"}
    before = {row.day: row.applied for row in rollup._stored().collect()}
    rollup.apply(table.changes(T[0], T[1]), T[0], T[1])
    after = {row.day: row.applied for row in rollup._stored().collect()}
    assert after == {**before, "d1": T[1], "d3": T[1]}
    assert maintained.TOTAL_TYPE == "decimal(38,4)"


# -- types and writers -----------------------------------------------------------


@pytest.mark.parametrize(
    "one, other, common",
    [
        (IntegerType(), LongType(), LongType()),
        (ByteType(), ShortType(), ShortType()),
        (FloatType(), DoubleType(), DoubleType()),
        (IntegerType(), DoubleType(), DoubleType()),
        (ShortType(), FloatType(), FloatType()),
        (IntegerType(), FloatType(), DoubleType()),
        (LongType(), DoubleType(), None),
        (DecimalType(10, 2), DecimalType(8, 4), DecimalType(12, 4)),
        (DecimalType(38, 0), DecimalType(10, 4), None),
        (IntegerType(), DecimalType(6, 2), DecimalType(12, 2)),
        (LongType(), DecimalType(10, 2), DecimalType(21, 2)),
        (DateType(), TimestampNTZType(), TimestampNTZType()),
        (StringType(), IntegerType(), None),
        (DecimalType(10, 2), DoubleType(), None),
    ],
)
def test_common_types(one, other, common):
    assert common_type(one, other) == common_type(other, one) == common


def test_columns_widen_over_the_history(spark, tmp_path):
    narrow = "id int, day string, n int, x float, m decimal(6,2), at int"
    wide = "id bigint, day string, n bigint, x double, m decimal(12,4), at int"
    made = VersionedTable.create(
        batch(spark, (1, "d", 7, 0.5, Decimal("1.25"), 1), (2, "d", 8, 1.5, None, 1), schema=narrow),
        str(tmp_path / "t"), "id", "day", "at", T[0],
    )
    big = 1 << 40
    made.upsert(batch(spark, (big, "d", big, 0.1, Decimal("12345678.0625"), 2), schema=wide), T[1])
    made.upsert(batch(spark, (2, "d", 9, 2.5, Decimal("3.50"), 3), schema=narrow), T[2])
    kinds = dict(made.snapshot().dtypes)
    assert [kinds[c] for c in ("id", "n", "x", "m")] == ["bigint", "bigint", "double", "decimal(12,4)"]
    rows = {r.id: (r.n, r.x, r.m) for r in made.snapshot().collect()}
    assert rows == {
        1: (7, 0.5, Decimal("1.2500")),
        big: (big, 0.1, Decimal("12345678.0625")),
        2: (9, 2.5, Decimal("3.5000")),
    }
    assert dict(made.as_of(T[0]).dtypes)["n"] == "int" and made.as_of(T[0]).count() == 2
    assert {r.id for r in made.incremental(T[0]).collect()} == {big, 2}
    assert [r.change_type for r in made.changes(T[1]).collect()] == ["update"]
    # from a compacted state in the narrower schema too
    made.compact()
    made.upsert(batch(spark, (1, "d", Decimal("1.5"), 4), schema="id int, day string, n decimal(4,1), at int"), T[3])
    assert dict(made.snapshot().dtypes)["n"] == "decimal(20,1)"
    assert {r.id: r.n for r in made.snapshot().collect()} == {1: Decimal("1.5"), big: big, 2: 9}


def test_types_without_a_common_one_are_refused(spark):
    old, new = (spark.createDataFrame([], s).schema for s in ("a int, b string", "B int"))
    with pytest.raises(ValueError, match="column B is string, not int"):
        evolve(old, new)


def test_the_later_of_two_writers_is_refused(spark, table, monkeypatch):
    one, two = (VersionedTable(spark, table.root) for _ in range(2))
    started = two._next(T[3])
    one.upsert(batch(spark, ("one", "d", 1.0, 1)), T[3])
    monkeypatch.setattr(two, "_next", lambda *_: started)
    with pytest.raises(ConcurrentCommit):
        two.upsert(batch(spark, ("two", "d", 1.0, 1)), T[3])
    with pytest.raises(ConcurrentCommit):
        two.delete(batch(spark, ("a", "d", 1.0, 1)), T[3])
    monkeypatch.undo()
    ids = {row.id for row in table.snapshot().collect()}
    assert "one" in ids and "two" not in ids and "a" in ids
    with pytest.raises(ConcurrentCommit, match="has come after"):
        two.upsert(batch(spark, ("two", "d", 1.0, 1)), "20240105000000000", expected=T[2])
    with pytest.raises(ConcurrentCommit):
        two.delete(batch(spark, ("a", "d", 1.0, 1)), "20240105000000000", expected=T[2])
    # it can start again
    two.upsert(batch(spark, ("two", "d", 1.0, 1)), "20240105000000000", expected=T[3])
    assert "two" in {row.id for row in one.snapshot().collect()}
    assert [c.commit_time for c in one.commits()] == [*T, "20240105000000000"]
