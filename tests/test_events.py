import os

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from signalloom.sources import events


def rows(spark, *pairs):
    return spark.createDataFrame([(i, t, e) for i, t, e in pairs], "item_id string, target string, event string")


def listed(df):
    return sorted((r.item_id, r.target, r.event) for r in df.collect())


def test_refused_events_are_sent_again_and_none_twice(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    first = rows(spark, ("1", "a", '{"n":1}'), ("1", "b", '{"n":1}'), ("2", "a", "not json"), ("3", "a", '"' + "x" * 50 + '"'), (None, "a", "{}"), ("4", "a", None), ("1", "a", '{"n":1}'))
    events.emit(first, path, live=True, most=40)
    assert tuple(events.summary(spark, path).first()) == (2, 4)
    assert sorted((r.item_id or "", r.error) for r in events.outcomes(spark, path).where("error is not null").collect()) == [("", "no item or target"), ("2", "no JSON"), ("3", "over 40 characters"), ("4", "no event")]
    events.emit(rows(spark, ("1", "a", '{"n":9}'), ("2", "a", "{}"), ("3", "a", '"short"')), path, live=True, most=40)
    events.emit(rows(spark, ("2", "a", '{"again":1}')), path, live=True, most=40)
    assert listed(events.delivered(spark, path)) == [("1", "a", '{"n":1}'), ("1", "b", '{"n":1}'), ("2", "a", "{}"), ("3", "a", '"short"')]
    assert tuple(events.summary(spark, path).first()) == (4, 4) and events.commits(spark, path).count() == 3


def test_a_dry_run_only_counts(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    events.emit(rows(spark, ("1", "a", "{}"), ("2", "a", "no")), path)
    assert tuple(events.summary(spark, path, live=False).first()) == (1, 1) and tuple(events.summary(spark, path).first()) == (0, 0)
    assert events.delivered(spark, path).count() == 0 and not os.path.exists(tmp_path / "out" / "attempts")
    assert events.delivered(spark, f"file://{tmp_path}/nothing").count() == 0


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    events.emit(rows(spark, ("1", "a", "{}")), path, live=True)
    bad = spark.range(0, 40, 1, 4).select(F.col("id").cast("string").alias("item_id"), F.lit("a").alias("target"), F.when(F.col("id") == 35, F.raise_error(F.lit("lost"))).otherwise("{}").alias("event"))
    with pytest.raises(Exception, match="lost"):
        bad.write.format("events").mode("append").option("path", path).option("live", "true").save()
    assert listed(events.delivered(spark, path)) == [("1", "a", "{}")] and events.commits(spark, path).count() == 1


def test_an_abort_takes_its_attempts_away(tmp_path):
    writer = events.EventWriter(f"file://{tmp_path}/out", 99, True, False)
    done = writer.write(iter([Row(item_id="1", target="a", event="{}")]))
    assert os.path.exists(tmp_path / "out" / done.file)
    writer.abort([done, None])
    writer.abort([])
    assert os.listdir(tmp_path / "out" / "attempts") == []


def test_files_of_lost_attempts_are_passed_over(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    events.emit(rows(spark, ("1", "a", "{}")), path, live=True)
    batch = os.listdir(tmp_path / "out" / "attempts")[0]
    (tmp_path / "out" / "attempts" / batch / "lost.jsonl").write_text('{"item_id":"9","target":"a","event":"{}"}\n')
    assert listed(events.delivered(spark, path)) == [("1", "a", "{}")]


def test_columns_are_checked(spark, tmp_path):
    spark.dataSource.register(events.EventSink)
    with pytest.raises(Exception, match="item_id, target and event"):
        spark.range(1).write.format("events").mode("append").option("path", f"file://{tmp_path}").save()
