"""Filters by criteria and text, and ordered pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalloom.session import scratch


def criteria(df: DataFrame, wanted: dict) -> DataFrame:
    """Rows that meet all criteria: a value is equalled (null by null alone), a list has the value in it."""
    tests = [F.col(c).isin(list(x)) if isinstance(x, (list, tuple, set)) else F.col(c).eqNullSafe(x) for c, x in wanted.items()]
    return df.where(reduce(lambda a, b: a & b, tests)) if tests else df


def text_search(df: DataFrame, query: str | None, columns: list[str]) -> DataFrame:
    """Rows in one of whose columns the query stands, upper and lower case alike; a blank query passes all."""
    query = (query or "").strip().lower()
    if not query:
        return df
    return df.where(reduce(lambda a, b: a | b, (F.contains(F.lower(F.coalesce(F.col(c), F.lit(""))), F.lit(query)) for c in columns)))


def any_or_equal(column: str, value: str | None) -> Column:
    """No filter for null or `all`."""
    return F.lit(True) if value in (None, "all") else F.col(column) == value


def page(df: DataFrame, sort: str, tie: str, limit: int = 0) -> DataFrame:
    """Sorted by a column (descending with a leading -; nulls lowest), ties by another; the first `limit` rows, all for 0."""
    name = sort.lstrip("-")
    order = F.col(name).desc_nulls_last() if sort.startswith("-") else F.col(name).asc_nulls_first()
    out = df.orderBy(order, F.col(tie))
    return out.limit(limit) if limit else out


def latest_items(items: DataFrame, domain: str | None = None, status: str | None = None, limit: int = 500) -> DataFrame:
    """items (labels, dispatch_status, captured_at, item_id) of a domain and dispatch state, newest first."""
    if not 1 <= limit <= 5000:
        raise ValueError("limit must be from 1 to 5000")
    rows = items.where(F.col("item_id").isNotNull())
    if domain:
        rows = rows.where(F.array_contains("labels", domain))
    if status:
        rows = rows.where(F.col("dispatch_status") == status)
    return page(rows, "-captured_at", "item_id", limit)


def by_locale(text: Column) -> Column:
    """Text as people sort it: letters before their accents, these before case. For sorting only; equal keys may be different texts, so another column should follow."""
    return F.collate(text, "UNICODE")


def placed(rows: DataFrame, *order: Column) -> DataFrame:
    """rows with place: their numbers from 0 in an order, which must be total. Rows are sorted by ranges and written once to the shared folder; only ranges are counted, so no task sees all rows."""
    spark, path = rows.sparkSession, scratch(rows.sparkSession)
    rows.orderBy(*order).select("*", F.monotonically_increasing_id().alias("_id")).write.parquet(path)
    written = spark.read.parquet(path).withColumn("_range", F.shiftright("_id", 33))
    sizes = written.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a range
    starts = sizes.select("_range", before.alias("_before"))
    return written.join(starts, "_range").select(*rows.columns, (F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).alias("place"))
