"""Signals from classified items, items from signals, and the four normalized streams of a ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalloom.functions import vocabulary as v
from signalloom.functions.keys import clamp, hash_id, per_hundred, percent
from signalloom.functions.text import filled, fold_words, title_of_id, upper_slug
from signalloom.operators.dedup import first_wins, last_wins

SIGNAL_PREFIX, MATTER_PREFIX, SOURCE_PREFIX = "SIG-", "MAT-", "SRC-RSS-"


def to_signals(items: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """A signal per classified item. sources: source_name, source_id; a source without an id gets one from its name."""
    primary = F.coalesce(F.lower(F.try_element_at("labels", F.lit(1))), F.lit("unclassified"))
    rows = items.withColumn("_known", F.lit(None).cast("string")) if sources is None else items.join(sources.select("source_name", F.col("source_id").alias("_known")), "source_name", "left")
    empty, nothing = F.array().cast("array<string>"), lambda t: F.lit(None).cast(t)
    return rows.select(
        F.concat(F.lit(SIGNAL_PREFIX), "item_id").alias("signal_id"), F.concat(F.lit(MATTER_PREFIX), "item_id").alias("matter_id"), F.concat(primary, F.lit("_signal")).alias("signal_type"),
        "title", F.substring(F.coalesce("body_text", F.lit("")), 1, 500).alias("summary"), F.coalesce("_known", upper_slug(F.col("source_name"), SOURCE_PREFIX)).alias("source_id"),
        "source_url", "captured_at", "published_at", F.lit("raw_observation").alias("signal_stage"), primary.alias("beat"), empty.alias("municipalities"), empty.alias("agencies"),
        empty.alias("entities"), nothing("double").alias("estimated_value"), nothing("string").alias("deadline_date"), nothing("double").alias("urgency_score"),
        percent(F.col("confidence")).alias("confidence_score"), "evidence_tier", F.lit("raw").alias("handoff_status"), F.lit(False).alias("is_synthetic"), "labels",
    )


def to_items(signals: DataFrame) -> DataFrame:
    """Items from signals that have an id, a url and a time; other fields fall back to defaults."""
    item = F.lower(F.element_at(F.split(F.coalesce("signal_id", F.lit("")), "-"), -1))
    rows = signals.withColumn("item_id", item).where((F.col("item_id") != "") & (F.coalesce("source_url", F.lit("")) != "") & F.col("published_at").isNotNull())
    return rows.select(
        "item_id", "source_url", title_of_id(F.coalesce("source_id", F.lit("")), (SOURCE_PREFIX,)).alias("source_name"), filled(F.col("title"), F.lit("(untitled signal)")).alias("title"),
        F.coalesce("summary", F.lit("")).alias("body_text"), "published_at", F.coalesce("captured_at", "published_at").alias("captured_at"), filled(F.col("evidence_tier"), F.lit("T2")).alias("evidence_tier"),
        F.when(F.size("labels") > 0, F.col("labels")).otherwise(F.array(F.lit(v.UNCLASSIFIED))).alias("labels"), clamp(F.coalesce("confidence_score", F.lit(0.0)) / 100).alias("confidence"),
    )


def check_ledger(signals: DataFrame) -> None:
    """Refuse an empty ledger and synthetic rows."""
    n = signals.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_synthetic").alias("made_up")).first()
    if not n.n or n.made_up:
        raise ValueError("empty ledger" if not n.n else f"{n.made_up} synthetic rows")


# Fixed value: how rows of the streams are said to be made.
METHOD = "deterministic_signal_projection"


def lineage(phase: str, inputs: list[str]) -> Column:
    return F.struct(F.lit("ledger.streams").alias("producer_script"), F.lit(phase).alias("producer_phase"), F.array(*map(F.lit, inputs)).alias("source_inputs"), F.lit(METHOD).alias("extraction_method"))


def streams(signals: DataFrame, registry: DataFrame, now: Column, jurisdiction: str = "PR", inputs: list[str] | None = None) -> dict[str, DataFrame]:
    """sources, entities, relationships and observations of a ledger.

    signals are numbered by `line`; sources, entities and relationships keep the first row of a key, observations the last. registry:
    source_id, name, source_family. Missing times are `now`, missing names the ids.
    """
    inputs = inputs or ["signals", "source_registry"]
    reg = registry.select(F.col("source_id").alias("_ref"), F.col("name").alias("_name"), F.col("source_family").alias("_family"))
    rows = signals.withColumns({
        "_created": F.coalesce("captured_at", now), "_confidence": per_hundred(F.col("confidence_score")), "_ref": F.col("source_id"),
        "_matter": filled(F.col("matter_id"), F.col("signal_id")), "_synthetic": F.coalesce("is_synthetic", F.lit(False)),
    })
    rows = rows.withColumns({"_source": hash_id("src", filled(F.col("source_id"), F.lit("unknown"))), "_entity": hash_id("ent", F.lit("matter"), F.col("_matter"))})
    common = [F.col("_synthetic").alias("synthetic"), F.col("_created").alias("created_at"), now.alias("extracted_at")]

    firsts = first_wins(rows, ["_source"], F.col("line")).join(reg, "_ref", "left")
    sources = firsts.select(F.col("_source").alias("source_id"), filled(F.col("_family"), F.lit("unknown")).alias("source_type"), filled(F.col("_name"), F.col("_ref"), F.lit("unknown")).alias("source_name"), filled(F.col("_ref"), F.lit("unknown")).alias("source_ref"), F.col("_confidence").alias("confidence"), lineage("SOURCE_REGISTRY", inputs).alias("lineage"), *common)

    def mentioned(column: str, kind: str, place: int, phase: str, confidence: Column | None, relation: str):
        each = rows.select("*", F.posexplode(column).alias("_pos", "_name")).withColumn("_other", hash_id("ent", F.lit(kind), fold_words(F.col("_name"))))
        nodes = each.select("line", F.lit(place).alias("_kind"), "_pos", F.col("_other").alias("entity_id"), F.col("_source").alias("source_id"), F.col("_name").alias("name"), fold_words(F.col("_name")).alias("normalized_name"), F.lit(kind).alias("entity_type"), F.lit(jurisdiction).alias("jurisdiction"), (F.col("_confidence") if confidence is None else confidence).alias("confidence"), lineage(phase, inputs).alias("lineage"), *common)
        edges = each.select("line", F.lit(place).alias("_kind"), "_pos", hash_id("rel", F.col("_entity"), F.lit(relation), F.col("_other")).alias("relationship_id"), F.col("_source").alias("source_id"), F.col("_entity").alias("source_entity_id"), F.col("_other").alias("target_entity_id"), F.lit(relation).alias("relationship_type"), F.col("_source").alias("evidence_source_id"), F.col("_confidence").alias("confidence"), lineage("RELATIONSHIP", inputs).alias("lineage"), *common)
        return nodes, edges

    title = filled(F.col("title"), F.col("_matter"))
    matters = rows.select("line", F.lit(0).alias("_kind"), F.lit(0).alias("_pos"), F.col("_entity").alias("entity_id"), F.col("_source").alias("source_id"), title.alias("name"), fold_words(title).alias("normalized_name"), F.lit("public_matter").alias("entity_type"), F.lit(jurisdiction).alias("jurisdiction"), F.col("_confidence").alias("confidence"), lineage("MATTER_ENTITY", inputs).alias("lineage"), *common)
    agencies, involves = mentioned("agencies", "agency", 1, "AGENCY_ENTITY", None, "involves_agency")
    places, located = mentioned("municipalities", "municipality", 2, "MUNICIPALITY_ENTITY", F.lit(0.95), "located_in")
    order = [F.col(c) for c in ("line", "_kind", "_pos")]
    entities = first_wins(matters.unionByName(agencies).unionByName(places), ["entity_id"], *order).drop("line", "_kind", "_pos")
    relationships = first_wins(involves.unionByName(located), ["relationship_id"], *order).drop("line", "_kind", "_pos")

    attributes = F.struct("signal_id", F.col("_matter").alias("matter_id"), "title", "summary", "signal_stage", "beat", "evidence_tier", "handoff_status", "deadline_date", "source_url")
    seen = rows.withColumn("_observation", hash_id("obs", F.lit("signal"), F.col("signal_id")))
    observations = last_wins(seen, ["_observation"], "line").select(F.col("_observation").alias("observation_id"), F.col("_entity").alias("entity_id"), F.col("_source").alias("source_id"), filled(F.col("signal_type"), F.lit("public_signal")).alias("observation_type"), F.col("_created").alias("observed_at"), attributes.alias("attributes"), F.col("_confidence").alias("confidence"), lineage("OBSERVATION", inputs).alias("lineage"), *common)
    return {"sources": sources, "entities": entities, "relationships": relationships, "observations": observations}
