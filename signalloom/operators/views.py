"""What a reader looks at: details of one item, matter or name, counts for a monitor, and the usual pages of each table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalloom.operators.entities import signals_of
from signalloom.operators.lifecycle import Store
from signalloom.operators.routing import dispatch_state
from signalloom.operators.search import page

# How each table is sorted, what breaks ties, and how many rows are looked at.
PAGES = {
    "signals": ("-captured_at", "signal_id", 200), "matters": ("-first_seen_at", "matter_id", 200), "records": ("-effective_date", "record_id", 200),
    "sources": ("name", "source_id", 300), "candidates": ("-created_date", "candidate_id", 50),
}
# States of sources that leave a gap, the least score that is high, the state of a signal that is ready, signals at the top.
GAPS, HIGH, READY, TOP = ("broken", "stale", "manual"), 85, "ready", 8


def required(df: DataFrame, what: str) -> DataFrame:
    """df, which must have a row."""
    if df.isEmpty():
        raise KeyError(f"{what} not found")
    return df


def item_detail(items: DataFrame, records: DataFrame, item_id: str) -> DataFrame:
    """An item with its dispatch record and state. No such item is an error."""
    one = F.col("item_id") == item_id
    return required(dispatch_state(items.where(one), records.where(one)), f"item {item_id}")


def matter_detail(store: Store, key: str) -> Store:
    """A matter, found by its matter_id or its id, and the signals and records that name the key or the matter's matter_id."""
    matters = store["matters"]
    found = F.col("matter_id") == key
    if "id" in matters.columns:
        found = found | F.coalesce(F.col("id") == key, F.lit(False))
    matter = required(matters.where(found), f"matter {key}")
    names = matter.select("matter_id").union(matter.select(F.lit(key))).distinct()
    return {"matters": matter} | {t: store[t].join(names, "matter_id", "left_semi") for t in ("signals", "records")}


def entity_detail(signals: DataFrame, profiles: DataFrame, mentioned: DataFrame, slug: str) -> Store:
    """A name's profile and the signals that mention it."""
    return {"profile": required(profiles.where(F.col("slug") == slug), f"entity {slug}"), "signals": signals_of(signals, mentioned, slug)}


def high_confidence(least: float = HIGH) -> Column:
    """A score that is high; none counts as 0."""
    return F.coalesce(F.col("confidence_score"), F.lit(0.0)) >= least


def monitor(store: Store) -> DataFrame:
    """One row: signals, matters, ready (signals that are, and candidates), high_confidence (signals), stale_sources."""
    signals = store["signals"].agg(F.count(F.lit(1)).alias("signals"), F.count_if(F.col("handoff_status") == READY).alias("_ready"), F.count_if(high_confidence()).alias("high_confidence"))
    matters, candidates = (store[t].agg(F.count(F.lit(1)).alias(c)) for t, c in (("matters", "matters"), ("candidates", "_candidates")))
    sources = store["sources"].agg(F.count_if(F.col("status").isin(*GAPS)).alias("stale_sources"))
    one = signals
    for part in (matters, candidates, sources):  # each is one row
        one = one.join(part, F.lit(True))
    return one.select("signals", "matters", (F.col("_ready") + F.col("_candidates")).alias("ready"), "high_confidence", "stale_sources")


def first_pages(store: Store, *tables: str) -> Store:
    """The first page of each table asked for, in its usual order; a column that a table lacks sorts as null. Tables that aren't there are left out."""
    out = {}
    for name in tables or PAGES:
        if name in store:
            sort, tie, limit = PAGES[name]
            df, column = store[name], sort.lstrip("-")
            known = df if column in df.columns else df.withColumn(column, F.lit(None).cast("string"))
            out[name] = page(known, sort, tie, limit).select(df.columns)
    return out


def top_signals(signals: DataFrame, n: int = TOP) -> DataFrame:
    """The first signals of the usual page."""
    return page(signals, PAGES["signals"][0], PAGES["signals"][1], n)


def by_confidence(matters: DataFrame) -> DataFrame:
    """Matters, the surest first; no score counts as 0."""
    return matters.orderBy(F.coalesce("confidence_score", F.lit(0.0)).desc(), "matter_id")


def matter_counts(store: Store) -> DataFrame:
    """Each matter's signals, records and sources, counted without collecting them. source ids are those of its signals."""
    signals = store["signals"].groupBy("matter_id").agg(F.count(F.lit(1)).alias("n_signals"), F.count_distinct("source_id").alias("n_sources"))
    records = store["records"].groupBy("matter_id").agg(F.count(F.lit(1)).alias("n_records"))
    rows = store["matters"].select("matter_id").join(signals, "matter_id", "left").join(records, "matter_id", "left")
    return rows.na.fill(0, ["n_signals", "n_sources", "n_records"])


def or_default(df: DataFrame, default: DataFrame) -> DataFrame:
    """df, or, if it has no rows, the default."""
    return default if df.isEmpty() else df


def sorted_targets(of: DataFrame, column: str = "target") -> DataFrame:
    """The distinct targets in order."""
    return of.select(column).distinct().orderBy(column)


def whole_percent(confidence: Column) -> Column:
    """A confidence from 0 to 1 in whole percent."""
    return F.round(confidence * 100).cast("int")


def short_id(column: Column, n: int = 12) -> Column:
    return F.substring(column, 1, n)


def display_date(date: Column, pattern: str = "d MMM yyyy") -> Column:
    """A date as text, empty if there is none."""
    return F.coalesce(F.date_format(date, pattern), F.lit(""))
