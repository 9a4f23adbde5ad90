"""Outbound events as a data source of Spark: `df.write.format("events")`, with a commit protocol.

Each task writes what it delivers, and what is refused, into an attempt's folder of its own, and says so in its commit message. Only a
commit makes attempts readable: the driver writes the list of their files, with the counts, as one file. A task that is repeated,
an executor that is lost or a job that fails leaves files that no list names; an abort deletes them. Whatever is read
back goes by these lists. Delivery is to a folder, and off unless asked for: a dry run only counts.
This module needs nothing else of the package, so workers get it with the write.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

EVENT = "item_id string, target string, event string, error string"


@dataclass
class Delivered(WriterCommitMessage):
    """A task's file, and how many of its events were delivered and refused."""

    file: str | None
    emitted: int
    failed: int


@dataclass
class EventWriter(DataSourceWriter):
    """most: characters of an event beyond which the receiver refuses it. live: whether anything is delivered at all."""

    path: str
    most: int
    live: bool
    overwrite: bool
    batch: str = field(default_factory=lambda: uuid.uuid4().hex)

    def refusal(self, row: Row) -> str | None:
        """Why the receiver doesn't take an event; null if it does."""
        if not row.item_id or not row.target:
            return "no item or target"
        if row.event is None or len(row.event) > self.most:
            return "no event" if row.event is None else f"over {self.most} characters"
        try:
            json.loads(row.event)
        except ValueError:
            return "no JSON"
        return None

    def write(self, rows: Iterator[Row]) -> Delivered:
        """Runs in a task: one file for its rows, written as they come; none for a dry run or a task without rows."""
        done, name, out = Delivered(None, 0, 0), f"attempts/{self.batch}/{uuid.uuid4().hex}.jsonl", None
        store, top = fs.FileSystem.from_uri(self.path)
        try:
            for row in rows:
                error = self.refusal(row)
                done.emitted, done.failed = done.emitted + (error is None), done.failed + (error is not None)
                if self.live:
                    if out is None:
                        store.create_dir(f"{top}/attempts/{self.batch}", recursive=True)
                        out = store.open_output_stream(f"{top}/{name}")
                    out.write((json.dumps({"item_id": row.item_id, "target": row.target, "event": row.event if error is None else None, "error": error}) + "\n").encode())
        finally:
            if out is not None:
                out.close()
        done.file = name if out is not None else None
        return done

    def commit(self, messages: list[Delivered | None]) -> None:
        """Runs once, on the driver, after all tasks have ended well."""
        done = [m for m in messages if m is not None]
        store, top = fs.FileSystem.from_uri(self.path)
        if self.overwrite and self.live:
            known = store.get_file_info(fs.FileSelector(f"{top}/commits", allow_not_found=True))
            for old in known:
                store.delete_file(old.path)
        store.create_dir(f"{top}/commits", recursive=True)
        whole = {"batch": self.batch, "live": self.live, "emitted": sum(m.emitted for m in done), "failed": sum(m.failed for m in done), "files": sorted(m.file for m in done if m.file)}
        # a file that is being written has a name that readers pass over
        with store.open_output_stream(f"{top}/commits/_{self.batch}") as out:
            out.write(json.dumps(whole).encode())
        store.move(f"{top}/commits/_{self.batch}", f"{top}/commits/{self.batch}.json")

    def abort(self, messages: list[Delivered | None]) -> None:
        store, top = fs.FileSystem.from_uri(self.path)
        if store.get_file_info(f"{top}/attempts/{self.batch}").type == fs.FileType.Directory:
            store.delete_dir(f"{top}/attempts/{self.batch}")


class EventSink(DataSource):
    """Options: path, a folder (a URI that Arrow can open); live (`true`: deliver; else only count), most (characters of an event)."""

    @classmethod
    def name(cls) -> str:
        return "events"

    def writer(self, schema: StructType, overwrite: bool) -> EventWriter:
        if not {"item_id", "target", "event"} <= set(schema.names):
            raise ValueError("events have item_id, target and event")
        return EventWriter(self.options["path"], int(self.options.get("most", 65_535)), self.options.get("live", "false").lower() == "true", overwrite)


def emit(events: DataFrame, path: str, live: bool = False, most: int = 65_535) -> None:
    """Deliver events (item_id, target, event as JSON) that haven't been: of an item and target, one event at most. What is refused is noted, and may be sent again."""
    spark = events.sparkSession
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(EventSink)
    rows = events.select("item_id", "target", "event").dropDuplicates(["item_id", "target"])
    done = outcomes(spark, path).where("error is null").select("item_id", "target")
    rows = rows.join(done, ["item_id", "target"], "left_anti")
    rows.write.format("events").mode("append").option("path", path).option("live", str(live).lower()).option("most", most).save()


def commits(spark: SparkSession, path: str) -> DataFrame:
    """batch, live, emitted, failed, files of every write that was committed; dry runs among them."""
    schema = "batch string, live boolean, emitted long, failed long, files array<string>"
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/commits")
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(f"{path}/commits")


def outcomes(spark: SparkSession, path: str) -> DataFrame:
    """item_id, target, event, error, batch of all that committed writes delivered (error is null) or had refused. Files that no commit names aren't read as if they were there."""
    files = commits(spark, path).select("batch", F.explode("files").alias("of"))
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/attempts")
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], EVENT + ", batch string")
    rows = spark.read.schema(EVENT).option("recursiveFileLookup", True).json(f"{path}/attempts")
    rows = rows.select("*", F.concat(F.lit("attempts/"), F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+/[^/]+)$", 1)).alias("of"))
    return rows.join(files, "of").drop("of")


def delivered(spark: SparkSession, path: str) -> DataFrame:
    """item_id, target, event: each event once that was delivered, however often it was sent."""
    return outcomes(spark, path).where("error is null").groupBy("item_id", "target").agg(F.min_by("event", "batch").alias("event"))


def summary(spark: SparkSession, path: str, live: bool = True) -> DataFrame:
    """One row: emitted and failed of all committed writes that were live, or of all dry runs."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return commits(spark, path).where(F.col("live") == live).agg(total("emitted"), total("failed"))
