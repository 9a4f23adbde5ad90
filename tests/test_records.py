from datetime import datetime

from pyspark.sql import functions as F

from signalloom.operators import records

ROWS = [(0, "a", "m1", "one"), (1, "b", "m1", "two"), (2, "m1", "x", "three"), (3, None, "m2", "four")]
IDS = ["id", "matter_id"]


def frames(spark, keys):
    return spark.createDataFrame(ROWS, "place int, id string, matter_id string, title string"), spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "turn int, key string")


def test_the_first_row_of_any_id_or_an_error(spark):
    rows, asked = frames(spark, ["b", "m1", "m2", "zzz", None, "b"])
    got = {r.turn: (r.row and r.row.title, r.error) for r in records.fetched(asked, "key", rows, IDS, "Matter").collect()}
    assert got == {0: ("two", None), 1: ("one", None), 2: ("four", None), 3: (None, "Matter not found: zzz"), 4: (None, "Matter not found: null"), 5: ("two", None)}
    assert records.fetched(asked.limit(0), "key", rows, IDS, "Matter").collect() == []


def test_patches_of_a_row_by_several_ids(spark):
    rows, _ = frames(spark, [])
    patches = spark.createDataFrame([(1, "a", "A", None), (2, "m1", None, "n"), (3, "a", "B", None), (4, "no", "C", "c")], "turn int, key string, title string, note string")
    out, answers = records.updated(patches, "key", rows, IDS, "Matter", F.lit(datetime(2026, 1, 1)))
    got = {r.place: (r.title, r.note, r.updated_date is not None) for r in out.collect()}
    assert got == {0: ("B", "n", True), 1: ("two", None, False), 2: ("three", None, False), 3: ("four", None, False)}
    assert {r.turn: r.error for r in answers.collect()} == {1: None, 2: None, 3: None, 4: "Matter not found: no"}
    assert out.columns == [*rows.columns, "note", "updated_date"]


def test_deleted_or_not(spark):
    rows, asked = frames(spark, ["m1", "m2", "none"])
    left, answers = records.deleted(asked, "key", rows, IDS)
    assert {r.key: (r.deleted, r.id) for r in answers.collect()} == {"m1": (True, "a"), "m2": (True, None), "none": (False, None)}
    assert sorted(r.place for r in left.collect()) == [1, 2] and left.columns == rows.columns


def test_priority_newest_then_first(spark):
    rows = spark.createDataFrame([(0, "c", "m", 5), (1, "c", "m", 9), (2, "c", "n", 9), (3, "", "m", 99)], "place int, candidate_id string, matter_id string, created_date int")
    asked = spark.createDataFrame([(0, "c", "n"), (1, "q", "n"), (2, "", "m"), (3, None, None)], "i int, candidate string, matter string")
    got = {r.i: r.place for r in records.prioritized(asked, rows, [("candidate", "candidate_id"), ("matter", "matter_id")]).collect()}
    assert got == {0: 1, 1: 2, 2: 3, 3: None}
