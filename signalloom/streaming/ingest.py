"""Incremental intake of a folder of items, as a stream that ends when it has caught up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from signalloom.operators.dedup import first_wins
from signalloom.sources.readers import RAW_ITEM
from signalloom.sources.sinks import merge_into


def raw_items(spark: SparkSession, path: str, delay: str = "7 days", files_a_batch: int = 1000) -> DataFrame:
    """Items of JSON-lines files as they land, each item id once within the delay."""
    stream = spark.readStream.schema(RAW_ITEM).option("maxFilesPerTrigger", files_a_batch).json(path)
    return stream.withWatermark("captured_at", delay).dropDuplicatesWithinWatermark(["item_id"])


def intake(items: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Upsert items by id, batch after batch, into a table; a batch that is run again writes the same version."""

    def one(batch: DataFrame, number: int) -> None:
        merge_into(first_wins(batch, ["item_id"], F.col("captured_at").desc(), F.col("source_url")), table, ["item_id"], f"{number:012d}")

    return items.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counts_by_window(events: DataFrame, time: str, kind: str, size: str, delay: str) -> DataFrame:
    """Counts by window of time and kind, for late data up to the delay."""
    return events.withWatermark(time, delay).groupBy(F.window(time, size).alias("w"), kind).agg(F.count(F.lit(1)).alias("n")).select("w.start", "w.end", kind, "n")
