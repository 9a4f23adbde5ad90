"""Readers of items, ledgers, registries, feeds, pages and payloads."""

from __future__ import annotations

import json

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from signalloom.functions.keys import item_id
from signalloom.functions.text import filled, strip
from signalloom.operators.dedup import first_wins
from signalloom.sources import feeds as landed_feeds
from signalloom.sources.feeds import ENTRY, entries_of, feed_key

RAW_ITEM = "item_id string, source_url string, source_name string, title string, body_text string, published_at timestamp, captured_at timestamp, evidence_tier string"
CLASSIFIED_ITEM = RAW_ITEM + ", labels array<string>, confidence double, classifier_reasoning string, municipalities array<string>, recipients array<string>, agencies array<string>, estimated_value double, signal_stage string, beat string"
SIGNAL = (
    "signal_id string, matter_id string, signal_type string, title string, summary string, source_id string, source_url string, captured_at timestamp, published_at timestamp, signal_stage string, beat string, "
    "municipalities array<string>, agencies array<string>, entities array<string>, estimated_value double, deadline_date string, urgency_score double, confidence_score double, evidence_tier string, handoff_status string, is_synthetic boolean, labels array<string>"
)
DISPATCH = "item_id string, dispatched_to array<string>, dispatched_at timestamp, status string, error string"
REGISTRY = "source_id string, name string, language string, source_family string, reliability_default double, scrape_method string, active string, notes string"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def json_files(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """One JSON object per file. Strict: a bad file is an error; else bad files, and a path that isn't there, give no rows. file_name orders them."""
    if not strict and not exists(spark, path):
        return spark.createDataFrame([], schema + ", file_name string")
    reader = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST" if strict else "DROPMALFORMED")
    return reader.json(path).withColumn("file_name", F.col("_metadata.file_name"))


def directory_counts(spark: SparkSession, **folders: str) -> DataFrame:
    """stage and n: how many files each folder holds (0 where there is none), by the names given."""
    out = spark.createDataFrame([], "stage string, n long")
    for stage, path in folders.items():
        files = spark.read.format("binaryFile").load(path).select("path") if exists(spark, path) else spark.createDataFrame([], "path string")
        out = out.unionByName(files.agg(F.lit(stage).alias("stage"), F.count(F.lit(1)).alias("n")))
    return out


def in_file_order(rows: DataFrame) -> DataFrame:
    """rows just read from files, with line: their numbers from 0, file after file by path. Only splits are counted; rows stay where they are read."""
    split = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
    numbered = rows.select("*", split.alias("_split"), F.monotonically_increasing_id().alias("_id"))
    sizes = numbered.groupBy("_split").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_split", "_first", before.alias("_before"))
    return numbered.join(starts, "_split").select(*rows.columns, (F.col("_before") + F.col("_id") - F.col("_first")).alias("line"))


def ledger(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Signals, one JSON object per line; blank lines are none. Strict: a bad line is an error; else it is left out."""
    return spark.read.schema(SIGNAL).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def ledger_lines(spark: SparkSession, path: str) -> DataFrame:
    """line (from 0) and value of a ledger's lines, for audits; lines of several files are numbered through."""
    return in_file_order(spark.read.text(path)).select("line", "value")


def ledgers(spark: SparkSession, paths: list[str], strict: bool = True) -> DataFrame:
    """Ledgers put together, in order; a path that isn't there is left out. line orders rows by ledger, then place."""
    out = spark.createDataFrame([], SIGNAL + ", line long")
    for i, path in enumerate(paths):
        if exists(spark, path):
            rows = in_file_order(ledger(spark, path, strict))
            out = out.unionByName(rows.withColumn("line", F.lit(i).cast("long") * (1 << 48) + F.col("line")))
    return out


def source_registry(spark: SparkSession, path: str) -> DataFrame:
    """The source registry from CSV; of repeated ids the last row counts, a missing file is an empty registry."""
    if not exists(spark, path):
        return spark.createDataFrame([], REGISTRY)
    rows = in_file_order(spark.read.schema(REGISTRY).option("header", True).csv(path))
    return first_wins(rows, ["source_id"], F.desc("line")).drop("line")


def feed_registry(spark: SparkSession, feeds: list[dict]) -> DataFrame:
    """name, url, tier and order of feeds, as read from configuration; a feed without a name goes by its url."""
    rows = [(i, f.get("name") or f.get("url", ""), f.get("url", ""), f.get("tier", "T2")) for i, f in enumerate(feeds)]
    return spark.createDataFrame(rows, "feed_order int, source_name string, url string, tier string")


def time_of(*texts: Column, now: Column) -> Column:
    """The first of several date texts that is one (RFC 822 or ISO-8601), else now."""
    bare = [F.regexp_replace(strip(t), r"^[A-Za-z]{3},\s*", "") for t in texts]
    read = [F.try_to_timestamp(t, F.lit(f)) for t in bare for f in ("d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss z")]
    return F.coalesce(*read, *(t.try_cast("timestamp") for t in texts), now)


def feed_items(entries: DataFrame, now: Column) -> DataFrame:
    """Raw items of feed entries (feed_order, entry_order, source_name, tier, link, title, summary, content, published, updated).

    Entries without a link are left out; of those with one item id the first by feed and place stays.
    """
    rows = entries.where(F.coalesce("link", F.lit("")) != "").withColumn("_published", time_of(F.col("published"), F.col("updated"), now=now))
    items = rows.select(
        "feed_order", "entry_order", item_id(F.col("link"), F.col("_published")).alias("item_id"), F.col("link").alias("source_url"), "source_name", strip(F.coalesce("title", F.lit(""))).alias("title"),
        F.coalesce(filled(F.col("summary"), F.col("content")), F.lit("")).alias("body_text"), F.col("_published").alias("published_at"), now.alias("captured_at"), F.coalesce("tier", F.lit("T2")).alias("evidence_tier"),
    )
    return first_wins(items, ["item_id"], F.col("feed_order"), F.col("entry_order")).drop("feed_order", "entry_order")


def feed_entries(documents: DataFrame) -> DataFrame:
    """Entries of landed feed documents (feed_order, source_name, tier, xml), with entry_order. A document that can't be read has none, which leaves the others as they are."""
    return _parsed(documents).select("feed_order", "source_name", "tier", F.posexplode("feed.entries").alias("entry_order", "entry")).select("feed_order", "entry_order", "source_name", "tier", "entry.*")


def feed_failures(documents: DataFrame) -> DataFrame:
    """feed_order, source_name and error of feed documents that can't be read."""
    return _parsed(documents).where("feed.error is not null").select("feed_order", "source_name", F.col("feed.error").alias("error"))


def _parsed(documents: DataFrame) -> DataFrame:
    @F.pandas_udf(f"entries array<struct<{ENTRY.replace(' string', ':string')}>>, error string")
    def parse(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([entries_of(t) for t in texts], columns=["entries", "error"])

    return documents.withColumn("feed", parse("xml"))


def scan_feeds(spark: SparkSession, path: str, feeds: list[dict]) -> DataFrame:
    """Entries of all feeds ({name, url, tier}, as read from configuration) whose documents have landed under path, in file after file; a feed or file that can't be read is a row with its error instead. Turns on, for the session, that Spark hands filters to Python data sources."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    cloudpickle.register_pickle_by_value(landed_feeds)
    spark.dataSource.register(landed_feeds.FeedSource)
    return spark.read.format("feeds").option("path", path).option("feeds", json.dumps(feeds)).load()


def poll_all(spark: SparkSession, path: str, feeds: list[dict], now: Column) -> DataFrame:
    """Raw items of all feeds that have landed under path: the first of each id by feed, file and place. Feeds and files that can't be read have none."""
    return feed_items(scan_feeds(spark, path, feeds).where("error is null"), now)


def land_feeds(documents: DataFrame, path: str) -> None:
    """Write feed documents (url, page, xml), each to a file of its own below its feed's folder. Documents of one feed are read in the order of their pages."""
    key = F.substring(F.sha2("url", 256), 1, 16)
    rows = documents.select(key.alias("feed"), F.col("page"), F.col("xml").alias("value"))
    # tasks write in the order of pages, and a file's name has its task's number first
    rows.repartitionByRange("feed", "page").sortWithinPartitions("feed", "page").select("feed", "value").write.option("maxRecordsPerFile", 1).partitionBy("feed").text(path)


def poll(feeds: DataFrame, landed: DataFrame, now: Column) -> DataFrame:
    """Raw items of all feeds (as feed_registry gives them) whose documents have landed (url, xml), in order of feeds and places."""
    return feed_items(feed_entries(feeds.join(landed, "url")), now)


def poll_feed(spark: SparkSession, landed: DataFrame, url: str, now: Column, source_name: str = "", tier: str = "T2") -> DataFrame:
    """Raw items of one feed, which goes by its url unless it is named."""
    return poll(feed_registry(spark, [{"name": source_name, "url": url, "tier": tier}]), landed, now)


def gazetteer(spark: SparkSession, path: str) -> DataFrame:
    schema = "features array<struct<canonical_id:string,canonical_name:string,normalized_name:string,feature_type:string,`group`:string>>"
    return spark.read.schema(schema).option("multiLine", True).json(path).select(F.inline("features"))


def grid(spark: SparkSession, path: str, header: list[str]) -> DataFrame:
    """A grid's cells from CSV, whose header must be as given."""
    df = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    found = [c.lstrip("﻿") for c in df.columns]
    if found != header:
        raise ValueError(f"header {found}")
    return df.toDF(*found)


def outbound(spark: SparkSession, path: str, only: str | None = None, item: str | None = None) -> DataFrame:
    """Payloads written by target (target, item_id, payload), in order of both; only one target's, if named, which prunes the others' folders, or one item's."""
    df = spark.read.schema("item_id string, payload string, target string").json(path)
    if only is not None:
        df = df.where(F.col("target") == only)
    if item is not None:
        df = df.where(F.col("item_id") == item)
    return df.where(F.col("payload").isNotNull()).select("target", "item_id", "payload").orderBy("target", "item_id")
