import json
import os

import pytest
from pyspark.sql import functions as F

from signalloom.sources import feeds, readers

RSS = '<rss xmlns:c="urn:c"><channel><title>F</title><item><title> One </title><link>http://r/{0}</link><description>d &amp; e</description><pubDate>Tue, 06 Jan 2026 10:00:00 GMT</pubDate></item><item><title>no link</title></item></channel></rss>'
ATOM = '<?xml version="1.0" encoding="utf-8"?><feed xmlns="http://www.w3.org/2005/Atom"><entry><title>Zwei ü</title><link rel="self" href="http://a/self"/><link href="http://a/2"/><content>c</content><updated>2026-02-03T04:05:06Z</updated></entry></feed>'
FEEDS = [{"name": "R", "url": "u1"}, {"name": "Bad", "url": "u2", "tier": "T1"}, {"url": "u3", "tier": "T1"}, {"name": "Evil", "url": "u4"}, {"name": "Gone", "url": "u5"}]


def landed(spark, tmp_path):
    path = f"file://{tmp_path}/landed"
    rows = [("u1", 0, RSS.format(1)), ("u1", 1, "<rss><item>"), ("u1", 2, RSS.format(2)), ("u1", 3, RSS.format(1)), ("u2", 0, "<rss><item>"), ("u3", 0, ATOM), ("u4", 0, "<!DOCTYPE x [<!ENTITY a 'b'>]><rss/>"), ("other", 0, RSS.format(9))]
    readers.land_feeds(spark.createDataFrame(rows, "url string, page long, xml string"), path)
    return path


def test_scan_gives_entries_and_failures(spark, tmp_path):
    got = readers.scan_feeds(spark, landed(spark, tmp_path), FEEDS)
    assert got.schema == spark.createDataFrame([], feeds.SCHEMA).schema
    rows = got.orderBy("feed_order", "entry_order").collect()
    read = [(r.source_name, r.tier, r.link) for r in rows if r.error is None]
    assert read == [("R", "T2", "http://r/1"), ("R", "T2", None), ("R", "T2", "http://r/2"), ("R", "T2", None), ("R", "T2", "http://r/1"), ("R", "T2", None), ("u3", "T1", "http://a/2")]
    assert sorted(r.source_name for r in rows if r.error is not None) == ["Bad", "Evil", "Gone", "R"]
    assert [r.file is None for r in rows if r.source_name == "Gone"] == [True]
    assert len({(r.feed_order, r.entry_order) for r in rows if r.error is None}) == 7


def test_poll_all_keeps_the_first_of_each_id(spark, tmp_path):
    got = readers.poll_all(spark, landed(spark, tmp_path), FEEDS, F.timestamp_seconds(F.lit(0))).collect()
    assert sorted((r.source_url, r.title, r.body_text, r.source_name) for r in got) == [("http://a/2", "Zwei ü", "c", "u3"), ("http://r/1", "One", "d & e", "R"), ("http://r/2", "One", "d & e", "R")]


def test_a_partition_a_feed_and_more_for_large_ones(spark, tmp_path, monkeypatch):
    path = landed(spark, tmp_path)
    parts = lambda: feeds.FeedReader(path, FEEDS).partitions()
    assert [(p.order, len(p.files), p.first) for p in parts()] == [(0, 4, 0), (1, 1, 0), (2, 1, 0), (3, 1, 0), (4, 0, 0)]
    monkeypatch.setattr(feeds, "PART", 1)
    assert [(p.order, len(p.files), p.first) for p in parts()] == [(0, 1, 0), (0, 1, 1), (0, 1, 2), (0, 1, 3), (1, 1, 0), (2, 1, 0), (3, 1, 0), (4, 0, 0)]
    assert readers.scan_feeds(spark, path, FEEDS).rdd.getNumPartitions() in (5, 8)  # the scan is planned in a process of its own


def test_pages_stay_in_order_beyond_a_thousand_files():
    names = [f"feed=x/part-00000-u.c{i:03}.txt" for i in range(1200)]
    assert sorted(reversed(names), key=feeds.in_order) == names


def test_filters_by_feed_reach_the_scan(spark, tmp_path):
    path = landed(spark, tmp_path)
    reader = feeds.FeedReader(path, FEEDS)
    left = list(reader.pushFilters([feeds.EqualTo(("source_name",), "u3"), feeds.EqualTo(("tier",), "T1")]))
    assert len(left) == 1 and [p.name for p in reader.partitions()] == ["u3"]
    got = readers.scan_feeds(spark, path, FEEDS).where("source_name in ('u3', 'Bad') and error is null")
    assert [r.link for r in got.collect()] == ["http://a/2"] and got.rdd.getNumPartitions() == 2


def test_options_are_checked(spark, tmp_path):
    for options in ({"feeds": json.dumps({"name": "x"}), "path": "file:///tmp"}, {"feeds": "[]"}):
        spark.dataSource.register(feeds.FeedSource)
        with pytest.raises(Exception, match="JSON list"):
            spark.read.format("feeds").options(**options).load().collect()
    empty = readers.scan_feeds(spark, f"file://{tmp_path}", [])
    assert empty.collect() == []
    os.makedirs(tmp_path / f"feed={feeds.feed_key('u')}")
    assert [r.error for r in readers.scan_feeds(spark, f"file://{tmp_path}", [{"url": "u"}]).collect()] == ["nothing has landed"]


def test_documents_that_are_no_feeds():
    for xml in (None, "", b"", "<a", "<?xml version='1.0' encoding='nope'?><rss/>", b"\xff\xfe", "<!DOCTYPE a><rss/>"):
        assert feeds.entries_of(xml)[0] == [] and feeds.entries_of(xml)[1]
    assert feeds.entries_of("<rss><channel/></rss>") == ([], None)
