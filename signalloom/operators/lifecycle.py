"""From signals to official records: readiness, wording, hand-over candidates and records.

Procedures take a snapshot (a dict of DataFrames) and give a new one; nothing is changed in place and times are arguments. They work on all
matters or requests of a batch at once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalloom.functions import vocabulary as v
from signalloom.functions.keys import matter_id, record_key, record_type, stage_order
from signalloom.functions.lexicon import folded_term
from signalloom.functions.text import bind, filled, fold
from signalloom.operators.dedup import patch

Store = dict[str, DataFrame]


def ready(matters: DataFrame, signals: DataFrame, triggers: list[str] = v.TRIGGERS) -> DataFrame:
    """matters with is_ready: a known trigger on it or its signals, an official identifier or url, or an official stage."""
    known = F.array(*map(F.lit, triggers))
    hit = signals.groupBy("matter_id").agg(F.bool_or(F.arrays_overlap(F.coalesce("handoff_triggers", F.array().cast("array<string>")), known)).alias("_hit"))
    own = F.coalesce(F.arrays_overlap("handoff_triggers", known), F.lit(False))
    official = F.coalesce(filled(F.col("official_identifier"), F.col("official_source_url")).isNotNull(), F.lit(False))
    is_ready = own | F.coalesce("_hit", F.lit(False)) | official | (stage_order(F.col("status_lifecycle")) >= v.OFFICIAL)
    return matters.join(hit, "matter_id", "left").withColumn("is_ready", is_ready).drop("_hit")


def badge(is_ready: Column) -> Column:
    return F.when(is_ready, "ready").otherwise("watching")


def language_guard(text: Column, stage: Column, claims: list[str] = v.OFFICIAL_CLAIMS) -> Column:
    """struct of status (blocked_official_claim before an official stage, needs_review after, clean) and blocked_matches."""

    def check(t: Column) -> Column:
        hits = F.filter(F.array(*(F.when(F.contains(t, F.lit(folded_term(c))), F.lit(c)) for c in claims)), lambda x: x.isNotNull())
        status = F.when(F.size(hits) == 0, "clean").when(stage_order(stage) < v.OFFICIAL, "blocked_official_claim").otherwise("needs_review")
        return F.struct(status.alias("status"), hits.alias("blocked_matches"))

    return bind(fold(F.coalesce(text, F.lit(""))), check)


def timeline(matters: DataFrame, stages: dict[str, int] = v.STAGES) -> DataFrame:
    """A row per matter and stage, with whether it is reached."""
    steps = F.array(*(F.struct(F.lit(s).alias("stage"), F.lit(o).alias("stage_order")) for s, o in stages.items()))
    return matters.withColumn("_now", stage_order(F.col("status_lifecycle"))).select("*", F.inline(steps)).withColumn("reached", F.col("stage_order") <= F.col("_now")).drop("_now")


def normalized_matter_id() -> Column:
    return filled(F.trim("matter_id"), matter_id(F.col("matter_type"), filled(F.col("title"), F.col("official_identifier"), F.lit("untitled")), F.col("first_seen_at").cast("string")))


def linked_ids(signals: DataFrame, matters: DataFrame) -> DataFrame:
    """matter_id and the sorted ids of its signals, for the matters named. A record holds these ids itself, so they are as many as a record can hold."""
    return signals.join(matters.select("matter_id").distinct(), "matter_id", "left_semi").groupBy("matter_id").agg(F.array_sort(F.collect_set("signal_id")).alias("linked_signal_ids"))


def evaluate(store: Store, now: Column) -> Store:
    """A hand-over candidate for each ready matter that has none; the matter points to it."""
    matters = ready(store["matters"], store["signals"]).where("is_ready").join(store["candidates"].select("matter_id"), "matter_id", "left_anti")
    summary = F.when(F.size("handoff_triggers") > 0, F.array_join("handoff_triggers", ", ")).otherwise("officialization_candidate")
    new = matters.join(linked_ids(store["signals"], matters), "matter_id", "left").select(
        F.concat_ws("-", F.lit("handoff"), "matter_id", F.unix_millis(now)).alias("candidate_id"), "matter_id", "title", F.lit("ready_for_review").alias("status"), F.lit("official_record").alias("target_record_type"),
        summary.alias("trigger_summary"), F.coalesce("linked_signal_ids", F.array().cast("array<string>")).alias("linked_signal_ids"), F.coalesce("confidence_score", F.lit(0.0)).alias("confidence_score"),
    )
    marks = new.select("matter_id", F.col("candidate_id").alias("last_handoff_candidate_id"), F.lit("handoff_ready").alias("sync_status"))
    return store | {"candidates": store["candidates"].unionByName(new, allowMissingColumns=True), "matters": patch(store["matters"], marks, "matter_id")}


def drafts(matters: DataFrame, signals: DataFrame, candidates: DataFrame, now: Column) -> DataFrame:
    """The official record that each accepted candidate would make. Records of one matter are numbered from the second on, in order of candidates."""
    wanted = candidates.select("matter_id", "candidate_id", F.col("target_record_type").alias("_type"), F.col("title").alias("_title"))
    nth = F.row_number().over(Window.partitionBy("matter_id").orderBy("candidate_id"))
    rows = wanted.withColumn("_nth", nth).join(matters, "matter_id").join(linked_ids(signals, wanted), "matter_id", "left")
    none = F.array().cast("array<string>")
    parties = F.filter(F.concat(F.coalesce("agencies", none), F.coalesce("organizations", none)), lambda x: F.coalesce(x, F.lit("")) != "")
    rows = rows.select(
        F.concat_ws("-", F.lit("record"), "matter_id", F.unix_millis(now), F.when(F.col("_nth") > 1, F.col("_nth"))).alias("record_id"), "matter_id", filled(F.col("_type"), record_type(F.col("matter_type"))).alias("record_type"),
        filled(F.col("title"), F.col("_title"), F.lit("Registro oficial pendiente")).alias("title"), F.coalesce("official_identifier", F.lit("")).alias("official_identifier"),
        F.coalesce("official_source_url", F.lit("")).alias("official_source_url"), "amount_confirmed", parties.alias("parties"), F.coalesce("linked_signal_ids", none).alias("linked_signal_ids"),
        F.col("candidate_id").alias("linked_candidate_id"), F.lit("pending_sync").alias("sync_status"),
    )
    return rows.withColumn("canonical_key", record_key(F.col("matter_id"), F.col("record_type"), F.col("official_identifier"), F.col("official_source_url"), F.col("title")))


def duplicates(records: DataFrame, existing: DataFrame) -> DataFrame:
    """records with duplicate_of: the existing record of the same canonical key, or else of the same matter, type and filled identifier."""
    by_key = existing.groupBy("canonical_key").agg(F.min("record_id").alias("_by_key"))
    same = ["matter_id", "record_type", "official_identifier"]
    by_identifier = existing.where(F.coalesce("official_identifier", F.lit("")) != "").groupBy(*same).agg(F.min("record_id").alias("_by_identifier"))
    rows = records.join(by_key, "canonical_key", "left").join(by_identifier, same, "left")
    return rows.withColumn("duplicate_of", F.coalesce("_by_key", "_by_identifier")).drop("_by_key", "_by_identifier")


def merge_records(store: Store, new: DataFrame, linked: str, created: str, nulls: bool) -> tuple[Store, DataFrame]:
    """Records with new ones (told apart by `draft`) added, or put into those that they duplicate; and what became of each new one: draft, matter_id, record_id, was_duplicate.

    A record that is there keeps its id and the columns that the new one lacks (and, without `nulls`, those that are null in it), and gets the signal ids of both. Of new ones
    that make one record the first counts, and the others are duplicates of it.
    """
    none = F.array().cast("array<string>")
    makes = Window.partitionBy("_makes")
    checked = duplicates(new, store["records"]).withColumn("_makes", F.coalesce(F.concat(F.lit("old:"), "duplicate_of"), F.concat(F.lit("new:"), "canonical_key")))
    checked = checked.withColumns({"_place": F.row_number().over(makes.orderBy("draft")), "_first": F.first("record_id").over(makes.orderBy("draft")), "_n": F.count(F.lit(1)).over(makes)})
    is_old = F.col("duplicate_of").isNotNull()
    done = checked.select("draft", "matter_id", F.coalesce("duplicate_of", "_first").alias("record_id"), (is_old | (F.col("_place") > 1)).alias("was_duplicate"))

    firsts = checked.where("_place = 1").withColumn("sync_status", F.when(is_old | (F.col("_n") > 1), linked).otherwise(created))
    helpers = ["draft", "duplicate_of", "_makes", "_place", "_first", "_n"]
    old_ids = store["records"].select(F.col("record_id").alias("duplicate_of"), F.col("linked_signal_ids").alias("_old"))
    changes = firsts.where(is_old).join(old_ids, "duplicate_of").withColumns({"record_id": F.col("duplicate_of"), "linked_signal_ids": F.array_union(F.coalesce("_old", none), F.coalesce("linked_signal_ids", none))})
    kept = patch(store["records"], changes.drop("_old", *helpers), "record_id", nulls)
    return store | {"records": kept.unionByName(firsts.where(~is_old).drop(*helpers), allowMissingColumns=True)}, done


def officialize(store: Store, done: DataFrame) -> Store:
    """Matters of merged records become official and point to them."""
    ids = done.groupBy("matter_id").agg(F.array_sort(F.collect_set("record_id")).alias("_new"))
    none = F.array().cast("array<string>")
    rows = store["matters"].join(ids, "matter_id", "left")
    hit = F.col("_new").isNotNull()
    rows = rows.withColumns({
        "status_lifecycle": F.when(hit, "officialized").otherwise(F.col("status_lifecycle")), "sync_status": F.when(hit, "synced_local").otherwise(F.col("sync_status")),
        "record_ids": F.when(hit, F.array_union(F.coalesce("record_ids", none), "_new")).otherwise(F.col("record_ids")),
    })
    return store | {"matters": rows.drop("_new")}


def accept(store: Store, accepted: DataFrame, now: Column) -> Store:
    """Accept candidates (accepted: candidate_id): records are made or linked, candidates, matters and their signals marked."""
    chosen = store["candidates"].join(accepted, "candidate_id", "left_semi")
    new = drafts(store["matters"], store["signals"], chosen, now).withColumn("draft", F.col("linked_candidate_id"))
    store, done = merge_records(store, new, "linked_existing", "created_local", nulls=True)
    store = officialize(store, done)
    outcome = done.select(F.col("draft").alias("candidate_id"), F.when(F.col("was_duplicate"), "linked_existing_record").otherwise("accepted_created_record").alias("status"), "record_id")
    marked = done.select("matter_id").distinct().withColumn("_hit", F.lit(True))
    signals = store["signals"].join(marked, "matter_id", "left").withColumn("handoff_status", F.when(F.col("_hit"), "matched").otherwise(F.col("handoff_status"))).drop("_hit")
    return store | {"candidates": patch(store["candidates"], outcome, "candidate_id"), "signals": signals.select(store["signals"].columns)}


def reject(store: Store, rejected: DataFrame) -> Store:
    """Reject candidates (rejected: candidate_id, reviewer_note). Ids that aren't there are an error."""
    if rejected.join(store["candidates"], "candidate_id", "left_anti").take(1):
        raise KeyError("candidate not found")
    marks = rejected.select("candidate_id", F.lit("rejected").alias("status"), filled(F.col("reviewer_note"), F.lit("Rejected.")).alias("reviewer_note"))
    return store | {"candidates": patch(store["candidates"], marks, "candidate_id")}


def sync(store: Store, records: DataFrame, now: Column | None = None) -> Store:
    """Take in official records from elsewhere; their matters become official. A record without an id gets one from its matter and time; a column that is null counts as not given."""
    now = F.current_timestamp() if now is None else now
    given = F.col("record_id") if "record_id" in records.columns else F.lit(None).cast("string")
    keyed = records.withColumns({"draft": F.to_json(F.struct(*sorted(records.columns))), "canonical_key": record_key(F.col("matter_id"), F.col("record_type"), F.col("official_identifier"), F.col("official_source_url"), F.col("title"))})
    keyed = keyed.dropDuplicates(["draft"])
    made = F.concat_ws("-", F.lit("record"), "matter_id", F.unix_millis(now), F.substring(F.sha2("canonical_key", 256), 1, 8))
    store, done = merge_records(store, keyed.withColumn("record_id", filled(given, made)), "updated_from_sync", "created_from_sync", nulls=False)
    return officialize(store, done)


PROCEDURES: dict[str, Callable] = {"evaluate": evaluate, "accept": accept, "reject": reject, "sync": sync}


def invoke(name: str, store: Store, *args) -> Store:
    """A procedure by name; an unknown one changes nothing."""
    return PROCEDURES[name](store, *args) if name in PROCEDURES else store
