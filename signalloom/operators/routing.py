"""Fan-out of items to targets, payloads, dispatch records and bounded events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalloom.functions import vocabulary as v
from signalloom.functions.numbers import fixed_exact
from signalloom.functions.keys import iso
from signalloom.functions.text import bind, truncated
from signalloom.operators.dedup import last_wins

BASE = ["item_id", "source_url", "source_name", "title", "body_text", "published_at", "captured_at", "evidence_tier", "labels", "confidence", "classifier_reasoning"]
FINANCE = ["municipalities", "recipients", "agencies", "estimated_value", "signal_stage", "beat"]


def targets(labels: Column, of: dict[str, str] = v.TARGETS, hub: str | None = v.HUB) -> Column:
    """Targets of an item's labels, each once, in label order; the hub last."""
    known = F.create_map(*(F.lit(x) for pair in of.items() for x in pair))
    mapped = F.array_distinct(F.filter(F.transform(labels, lambda x: F.element_at(known, x)), lambda t: t.isNotNull()))
    return mapped if hub is None else F.array_union(mapped, F.array(F.lit(hub)))


def passes(threshold: float = v.GATE) -> Column:
    return F.coalesce(F.col("confidence"), F.lit(0.0)) >= threshold


def fan_out(items: DataFrame, of: dict[str, str] = v.TARGETS, hub: str = v.HUB, threshold: float = v.GATE) -> DataFrame:
    """A row per item that passes the gate and target, with the target's place in order."""
    return items.where(passes(threshold)).select("*", F.posexplode(targets(F.col("labels"), of, hub)).alias("target_order", "target"))


def payloads(routed: DataFrame, routed_at: Column, finance=v.FINANCE_TARGETS, water=v.WATER_TARGETS) -> DataFrame:
    """item_id, target, payload (JSON): base fields for all; enrichment for finance targets, fine tags for water targets and the hub.

    routed has the base fields, the enrichment and with_flags' columns; `body_text` and arrays are kept as they are.
    """
    base = [iso(F.col(c)).alias(c) if c.endswith("_at") else F.col(c) for c in BASE]
    fields = [F.lit("1.0").alias("schema_version"), *base, F.col("target").alias("routed_to"), iso(routed_at).alias("routed_at"), "is_critical"]
    money, tagged = F.col("target").isin(*finance), F.col("target").isin(*water)
    as_json = lambda *more: F.to_json(F.struct(*fields, *more), {"ignoreNullFields": "false"})
    both = F.when(money & tagged, as_json(*FINANCE, "domain_tags")).when(money, as_json(*FINANCE)).when(tagged, as_json("domain_tags")).otherwise(as_json())
    return routed.select("item_id", "target", both.alias("payload"))


#: What a payload may hold, for reading it back.
PAYLOAD = (
    "schema_version string, item_id string, source_url string, source_name string, title string, body_text string, published_at string, captured_at string, evidence_tier string, labels array<string>, confidence double, "
    "classifier_reasoning string, routed_to string, routed_at string, is_critical boolean, municipalities array<string>, recipients array<string>, agencies array<string>, estimated_value double, signal_stage string, beat string, domain_tags array<string>"
)


def dispatch_records(items: DataFrame, dispatched_at: Column, errors: DataFrame | None = None, of: dict[str, str] = v.TARGETS, hub: str = v.HUB, threshold: float = v.GATE) -> DataFrame:
    """A record per item: item_id, dispatched_to, dispatched_at, status, error. errors: item_id, target, error of writes that failed.

    Items below the gate are skipped; those with any failed target failed, and keep the targets that were reached.
    """
    to = targets(F.col("labels"), of, hub)
    if errors is None:
        rows = items.withColumns({"_failed": F.array().cast("array<string>"), "_error": F.lit(None).cast("string")})
    else:
        failed = errors.groupBy("item_id").agg(F.collect_set("target").alias("_failed"), F.array_join(F.array_sort(F.collect_list(F.concat_ws(": ", "target", "error"))), "; ").alias("_error"))
        rows = items.join(failed, "item_id", "left").withColumn("_failed", F.coalesce("_failed", F.array().cast("array<string>")))
    fine = passes(threshold)
    why = F.concat(F.lit("confidence "), fixed_exact(F.coalesce("confidence", F.lit(0.0)), 2), F.lit(f" below {threshold:.2f}"))
    return rows.select(
        "item_id", F.when(fine, F.array_except(to, "_failed")).otherwise(F.array().cast("array<string>")).alias("dispatched_to"), dispatched_at.alias("dispatched_at"),
        F.when(~fine, "skipped").when(F.size("_failed") > 0, "failed").otherwise("ok").alias("status"), F.when(fine, F.col("_error")).otherwise(why).alias("error"),
    )


def dispatch_state(items: DataFrame, records: DataFrame) -> DataFrame:
    """items with dispatch (struct or null) and dispatch_status (pending without a record). Of several records of an item the last counts, by dispatched_at if there is one."""
    names = sorted((c for c in records.columns if c != "item_id"), key=lambda c: c != "dispatched_at")
    one = last_wins(records, ["item_id"], *names).select("item_id", F.struct(*names).alias("dispatch"))
    return items.join(one, "item_id", "left").withColumn("dispatch_status", F.coalesce("dispatch.status", F.lit("pending")))


def run_summary(items: DataFrame, records: DataFrame) -> DataFrame:
    """One row: ingested, dispatched (ok), gated (skipped), and breakdown (a map of each state's count)."""
    states = dispatch_state(items, records).groupBy("dispatch_status").agg(F.count(F.lit(1)).alias("n"))
    of = lambda state: F.coalesce(F.sum(F.when(F.col("dispatch_status") == state, F.col("n"))), F.lit(0)).cast("long")
    breakdown = F.map_from_entries(F.array_sort(F.collect_list(F.struct("dispatch_status", "n"))))
    return states.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("ingested"), of("ok").alias("dispatched"), of("skipped").alias("gated"), breakdown.alias("breakdown"))


def emit_summary(sent: DataFrame) -> DataFrame:
    """One row: emitted and failed, of events with an error (null where none)."""
    return sent.agg(F.count_if(F.col("error").isNull()).alias("emitted"), F.count_if(F.col("error").isNotNull()).alias("failed"))


#: Characters of a body, and of a whole event.
MOST_BODY, MOST_EVENT, LEAST_BODY = 8000, 60_000, 100
MARKER = "… [truncated]"


def ascii_length(text: Column) -> Column:
    """Characters of a JSON text in which all beyond ASCII are written as \\u and four digits, once or, beyond the first plane, twice. Runs of other characters are taken out at once, so no character is a match of its own."""
    count = lambda t, others: F.length(F.regexp_replace(t, others, ""))
    other = lambda t: 6 * F.length(t) - 5 * count(t, r"[^\x00-\x7F]+") + 6 * count(t, r"[^\x{10000}-\x{10FFFF}]+")
    return bind(text, lambda t: F.when(F.octet_length(t) == F.length(t), F.length(t)).otherwise(other(t)))


def bounded_events(rows: DataFrame, event_type: str, most: int = MOST_EVENT) -> DataFrame:
    """item_id, target, event (JSON), event_chars (of its payload): rows (item_id, target, signal: a struct with body_text) wrapped for sending.

    Bodies are cut to MOST_BODY characters. If the payload is still longer than `most`, the first of the body's halves, marked, half of that, and so on, that fits
    stays; one under LEAST_BODY characters isn't worth sending and is empty.
    """
    whole = F.struct("item_id", F.col("target").alias("repo"), "signal")
    as_json = lambda of: F.to_json(of, {"ignoreNullFields": "false"})
    # a body adds to the payload what it takes as JSON itself: the rest is written out once, however many bodies are tried
    size = lambda body: ascii_length(as_json(F.struct(F.coalesce(body, F.lit("")).alias("b")))) - len('{"b":""}')
    rest = ascii_length(as_json(F.struct("item_id", F.col("target").alias("repo"), F.col("signal").withField("body_text", F.lit("")).alias("signal"))))
    half = lambda t: F.floor(F.length(t) / 2).cast("int")
    shorter = lambda t: F.when(half(t) >= LEAST_BODY, F.concat(F.substring(t, F.lit(1), half(t)), F.lit(MARKER))).otherwise("")
    turns = F.sequence(F.lit(1), F.lit(MOST_BODY.bit_length()))

    def chosen(body: Column, room: Column) -> Column:
        smaller = F.aggregate(turns, F.array(body), lambda done, _: F.concat(done, F.array(shorter(F.element_at(done, -1)))))
        fitting = F.try_element_at(F.filter(smaller, lambda t: size(t) <= room), F.lit(1))
        return F.when(body.isNull() | (size(body) <= room), body).otherwise(F.coalesce(fitting, F.lit("")))

    tried = F.struct(bounded_body(F.col("signal.body_text")).alias("body"), (F.lit(most) - rest).alias("room"))
    # a null body takes no text but the word null, which is two characters more than an empty one
    both = bind(tried, lambda t: F.struct(chosen(t["body"], t["room"]).alias("body"), (F.lit(most) - t["room"]).alias("rest")))
    rows = rows.select("item_id", "target", "signal", F.explode(F.array(both)).alias("_has"))
    chars = F.col("_has.rest") + F.when(F.col("signal").isNull(), 0).when(F.col("_has.body").isNull(), 2).otherwise(size(F.col("_has.body")))
    rows = rows.select("item_id", "target", F.col("signal").withField("body_text", F.col("_has.body")).alias("signal"), chars.cast("long").alias("event_chars"))
    event = as_json(F.struct(F.lit(event_type).alias("event_type"), whole.alias("client_payload")))
    return rows.select("item_id", "target", event.alias("event"), "event_chars")


def bounded_body(text: Column, most: int = MOST_BODY) -> Column:
    return truncated(text, most, MARKER)
