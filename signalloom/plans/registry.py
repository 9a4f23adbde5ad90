"""Every query of the engine by name, over the driver's tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalloom.functions import extract, keys, numbers, pages, text
from signalloom.functions import vocabulary as v
from signalloom.functions.lexicon import agencies, is_critical, tags
from signalloom.operators import classify, dedup, entities, ledger, lifecycle, lookup, overlay, quality, records, routing, schemas, search, views
from signalloom.plans import bindings as b
from signalloom.session import scratch, ship
from signalloom.sources import events, readers, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(spark, sf_dir)

        QUERIES[f.__name__] = run
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def joined(c: str):
    return F.array_join(c, ",").alias(c)


def whole_text():
    return F.concat("title", F.lit(" "), "body_text")


# -- tags, tiers and routing --


@query(f"{b.BASE} SELECT item_id, array_to_string(kw, ',') AS tags FROM classified")
def lexicon_tags(spark, sf):
    return b.items(spark, sf).select("item_id", F.array_join(tags(whole_text(), b.DOMAINS), ",").alias("tags"))


@query(f"{b.BASE} SELECT tag, count(*) AS n FROM (SELECT unnest(kw) AS tag FROM classified) GROUP BY tag")
def lexicon_breakdown(spark, sf):
    return b.items(spark, sf).select(F.explode(tags(whole_text(), b.DOMAINS)).alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {b.ITEMS} SELECT lang, count(*) AS n, count(*) FILTER ({b.sql_has('folded', b.URGENT)}) AS critical FROM items GROUP BY lang")
def critical_flag_by_lang(spark, sf):
    return b.items(spark, sf).groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count_if(is_critical(whole_text(), b.URGENT)).alias("critical"))


@query(f"{b.BASE} SELECT item_id, array_to_string(labels, ',') AS labels, confidence, CAST(printf('%.1f', CAST(confidence AS DOUBLE) * 100) AS DOUBLE) AS score FROM classified")
def classify_tiers(spark, sf):
    return classify.classify(b.items(spark, sf), b.DOMAINS).select("item_id", joined("labels"), F.col("confidence"), keys.percent(F.col("confidence")).alias("score"))


@query(
    f"""{b.BASE}, p AS (SELECT CAST(doc_id AS VARCHAR) AS pid, CASE WHEN toxic = 1 THEN 0.9 END AS mc FROM labels WHERE quality = 1)
SELECT item_id, CASE WHEN len(kw) >= 2 OR pid IS NULL THEN array_to_string(labels, ',') ELSE array_to_string(list_concat(['POLITICAL'], list_filter(kw, lambda x: x <> 'POLITICAL')), ',') END AS labels,
CASE WHEN len(kw) >= 2 OR pid IS NULL THEN confidence ELSE coalesce(mc, 0.5) END AS confidence FROM classified LEFT JOIN p ON item_id = pid"""
)
def classify_with_predictions(spark, sf):
    known = b.table(spark, sf, "labels").where("quality = 1")
    predictions = known.select(F.col("doc_id").cast("string").alias("item_id"), F.array(F.lit("POLITICAL"), F.lit("NO_SUCH_LABEL")).alias("model_labels"), F.when(F.col("toxic") == 1, 0.9).alias("model_confidence"), F.lit("table").alias("model_reasoning"))
    return classify.classify(b.items(spark, sf), b.DOMAINS, predictions).select("item_id", joined("labels"), "confidence")


@query(
    f"""{b.BASE}, s AS (SELECT *, length(body_text) AS n, len(kw) < 2 AND length(body_text) % 10 NOT IN (3, 7) AS scored,
  CASE length(body_text) % 3 WHEN 0 THEN ['FINANCIAL'] WHEN 1 THEN ['UNCLASSIFIED'] ELSE ['POLITICAL', 'SAFETY_COMPLIANCE'] END AS model FROM classified)
SELECT item_id, array_to_string(CASE WHEN scored THEN list_concat(model, list_filter(kw, lambda x: NOT list_contains(model, x))) ELSE labels END, ',') AS labels,
CASE WHEN scored THEN CASE WHEN n % 10 = 0 THEN 0.5 ELSE CAST(n % 100 AS DOUBLE) / 100 END ELSE confidence END AS confidence, len(kw) < 2 AND n % 10 IN (3, 7) AS failed FROM s"""
)
def classify_with_scorer(spark, sf):
    """Whole texts scored; the scorer raises for batches with an item that it can't take, and answers some with what isn't JSON."""
    rows = classify.classify_with_scorer(b.items(spark, sf), b.length_scorer, b.DOMAINS, most=None)
    return rows.select("item_id", joined("labels"), "confidence", F.col("scorer_error").isNotNull().alias("failed"))


@query(f"{b.BASE}, t AS (SELECT unnest({b.sql_targets(v.TARGETS, v.HUB)}) AS target FROM classified WHERE confidence >= 0.55) SELECT target, count(*) AS n FROM t GROUP BY target")
def route_fanout_counts(spark, sf):
    routed = routing.fan_out(classify.classify(b.items(spark, sf), b.DOMAINS))
    return routed.groupBy("target").agg(F.count(F.lit(1)).alias("n"))


@query(f"{b.BASE} SELECT item_id, array_to_string({b.sql_targets(v.TARGETS, v.HUB)}, ',') AS targets FROM classified")
def resolve_targets(spark, sf):
    rows = classify.classify(b.items(spark, sf), b.DOMAINS)
    return rows.select("item_id", F.array_join(routing.targets(F.col("labels")), ",").alias("targets"))


@query(
    f"""{b.BASE}, e AS (SELECT CAST(doc_id AS VARCHAR) AS eid FROM labels WHERE toxic = 1), r AS (SELECT *, {b.sql_targets(v.TARGETS, v.HUB)} AS t FROM classified LEFT JOIN e ON item_id = eid)
SELECT item_id, CASE WHEN confidence < 0.55 THEN '' WHEN eid IS NULL THEN array_to_string(t, ',') ELSE array_to_string(list_filter(t, lambda x: x <> 'hub'), ',') END AS dispatched_to,
CASE WHEN confidence < 0.55 THEN 'skipped' WHEN eid IS NOT NULL THEN 'failed' ELSE 'ok' END AS status,
CASE WHEN confidence < 0.55 THEN printf('confidence %.2f below 0.55', confidence) WHEN eid IS NOT NULL THEN 'hub: unreachable' END AS error FROM r"""
)
def dispatch_records(spark, sf):
    failed = b.table(spark, sf, "labels").where("toxic = 1").select(F.col("doc_id").cast("string").alias("item_id"), F.lit("hub").alias("target"), F.lit("unreachable").alias("error"))
    rows = routing.dispatch_records(classify.classify(b.items(spark, sf), b.DOMAINS), F.lit("2026-01-01 00:00:00").cast("timestamp"), failed)
    return rows.select("item_id", joined("dispatched_to"), "status", "error")


def label_records(spark, sf):
    state = F.when(F.col("quality") == 1, "ok").when(F.col("toxic") == 1, "failed").otherwise("skipped")
    return b.table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("item_id"), state.alias("status"))


STATES = "st AS (SELECT CAST(doc_id AS VARCHAR) AS sid, CASE WHEN quality = 1 THEN 'ok' WHEN toxic = 1 THEN 'failed' ELSE 'skipped' END AS status FROM labels)"


@query(f"WITH {b.ITEMS}, {STATES} SELECT coalesce(status, 'pending') AS dispatch_status, count(*) AS n FROM items LEFT JOIN st ON item_id = sid GROUP BY 1")
def dispatch_status_breakdown(spark, sf):
    return routing.dispatch_state(b.items(spark, sf), label_records(spark, sf)).groupBy("dispatch_status").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {b.ITEMS}, {STATES} SELECT count(*) AS ingested, count(*) FILTER (status = 'ok') AS dispatched, count(*) FILTER (status = 'skipped') AS gated, count(*) FILTER (status IS NULL) AS pending FROM items LEFT JOIN st ON item_id = sid")
def run_summary(spark, sf):
    return routing.run_summary(b.items(spark, sf), label_records(spark, sf)).select("ingested", "dispatched", "gated", F.coalesce(F.col("breakdown")["pending"], F.lit(0)).alias("pending"))


@query(f"{b.BASE}, {STATES} SELECT item_id, captured_at, coalesce(status, 'pending') AS dispatch_status FROM classified LEFT JOIN st ON item_id = sid WHERE list_contains(labels, 'SAFETY_COMPLIANCE') AND coalesce(status, 'pending') = 'pending' ORDER BY captured_at DESC, item_id LIMIT 50")
def items_topk(spark, sf):
    # states are cheap to find, so labels are worked out for pending items alone
    pending = routing.dispatch_state(b.items(spark, sf), label_records(spark, sf)).where("dispatch_status = 'pending'")
    return search.latest_items(classify.classify(pending, b.DOMAINS), "SAFETY_COMPLIANCE", "pending", 50).select("item_id", "captured_at", "dispatch_status")


@query(f"{b.BASE} SELECT item_id, CASE WHEN list_contains(['water', 'hub'], t) THEN 'tags' ELSE '' END || CASE WHEN t = 'finance' THEN 'money' ELSE '' END AS extra, t AS target, title FROM (SELECT *, unnest({b.sql_targets(v.TARGETS, v.HUB)}) AS t FROM classified WHERE confidence >= 0.55)")
def payload_fields(spark, sf):
    rows = classify.described(b.items(spark, sf), b.DOMAINS, urgent=b.URGENT, water=b.DOMAINS)
    made = routing.payloads(routing.fan_out(rows), F.lit("2026-01-01 00:00:00").cast("timestamp"))
    names = F.json_object_keys("payload")
    extra = F.concat(F.when(F.array_contains(names, "domain_tags"), "tags").otherwise(""), F.when(F.array_contains(names, "recipients"), "money").otherwise(""))
    return made.select("item_id", "target", extra.alias("extra"), F.get_json_object("payload", "$.title").alias("title"))


@query(
    f"""{b.BASE} SELECT item_id, t AS target, t AS routed_to, '1.0' AS schema_version, source_url, source_name, body_text, strftime(published_at, '%Y-%m-%dT%H:%M:%S+00:00') AS published_at,
strftime(captured_at, '%Y-%m-%dT%H:%M:%S+00:00') AS captured_at, '2026-01-01T00:00:00+00:00' AS routed_at, evidence_tier, array_to_string(labels, ',') AS labels, confidence, {b.sql_has("folded", b.URGENT)} AS is_critical,
CASE WHEN list_contains(['water', 'hub'], t) THEN array_to_string(kw, ',') END AS domain_tags FROM (SELECT *, unnest({b.sql_targets(v.TARGETS, v.HUB)}) AS t FROM classified WHERE confidence >= 0.55)"""
)
def payload_contents(spark, sf):
    """What payloads say, read back from their JSON."""
    rows = classify.with_flags(classify.classify(classify.with_folded(b.items(spark, sf)), b.DOMAINS), b.URGENT, b.DOMAINS)
    for name, kind in {"municipalities": "array<string>", "recipients": "array<string>", "agencies": "array<string>", "estimated_value": "double", "signal_stage": "string", "beat": "string"}.items():
        rows = rows.withColumn(name, F.lit(None).cast(kind))  # amounts and names have queries of their own
    made = routing.payloads(routing.fan_out(rows), F.lit("2026-01-01 00:00:00").cast("timestamp")).select("item_id", "target", F.from_json("payload", routing.PAYLOAD).alias("p"))
    plain = ["routed_to", "schema_version", "source_url", "source_name", "body_text", "published_at", "captured_at", "routed_at", "evidence_tier", "confidence", "is_critical"]
    return made.select("item_id", "target", *(F.col(f"p.{c}") for c in plain), *(F.array_join(f"p.{c}", ",").alias(c) for c in ("labels", "domain_tags")))


@query(
    f"""WITH {b.ITEMS}, r AS (SELECT CAST(user_id AS VARCHAR) AS rid, event_type, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type DESC, event_id DESC) AS place FROM events)
SELECT item_id, coalesce(event_type, 'pending') AS dispatch_status, event_id FROM items LEFT JOIN r ON item_id = rid AND place = 1"""
)
def dispatch_last_record(spark, sf):
    """Items with the last of many records each."""
    records = b.table(spark, sf, "events").select(F.col("user_id").cast("string").alias("item_id"), F.col("event_type").alias("status"), "event_id", F.col("ts").alias("dispatched_at"))
    return routing.dispatch_state(b.items(spark, sf), records).select("item_id", "dispatch_status", "dispatch.event_id")


@query("SELECT doc_id, CASE WHEN length(text) > 8000 THEN substr(text, 1, 8000) || '… [truncated]' ELSE text END AS body FROM documents")
def payload_bound(spark, sf):
    return b.table(spark, sf, "documents").select("doc_id", routing.bounded_body(F.col("text")).alias("body"))


_event = "to_json(struct_pack(item_id := doc_id, repo := 'finance', signal := struct_pack(body_text := body, lang := lang, note := note)))::VARCHAR"
_event_chars = f"length(regexp_replace(regexp_replace({_event}, '[\\x{{10000}}-\\x{{10FFFF}}]', '............', 'g'), '[^\\x00-\\x7F]', '......', 'g'))"


@query(
    f"""WITH RECURSIVE h AS (SELECT doc_id, lang, repeat('é', (doc_id * 37) % 12000) AS note, CASE WHEN length(text) > 8000 THEN substr(text, 1, 8000) || '… [truncated]' ELSE text END AS body, 0 AS k FROM documents
UNION ALL SELECT doc_id, lang, note, CASE WHEN length(body) // 2 >= 100 THEN substr(body, 1, length(body) // 2) || '… [truncated]' ELSE '' END, k + 1 FROM h WHERE body <> '' AND {_event_chars} > 60000),
l AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY k DESC) AS r FROM h)
SELECT doc_id AS item_id, sha256(body) AS body_sha256, {_event_chars} AS event_chars FROM l WHERE r = 1"""
)
def bounded_events(spark, sf):
    """Documents as signals, whose notes take up to more than all the room of an event."""
    note = F.repeat(F.lit("é"), (F.col("doc_id") * 37 % 12000).cast("int"))
    rows = b.table(spark, sf, "documents").select(F.col("doc_id").alias("item_id"), F.lit("finance").alias("target"), F.struct(F.col("text").alias("body_text"), "lang", note.alias("note")).alias("signal"))
    made = routing.bounded_events(rows, "signal_ready")
    return made.select("item_id", F.sha2(F.get_json_object("event", "$.client_payload.signal.body_text"), 256).alias("body_sha256"), "event_chars")


# -- keys and de-duplication --


@query("SELECT page_id, substr(sha256(url || '|' || strftime(make_timestamp((1700000000 + page_id) * 1000000 + (page_id % 3) * 250), '%Y-%m-%dT%H:%M:%S') || CASE WHEN page_id % 3 = 0 THEN '' ELSE '.' || lpad(CAST((page_id % 3) * 250 AS VARCHAR), 6, '0') END || '+00:00'), 1, 16) AS item_id FROM pages")
def item_id_hash(spark, sf):
    ts = F.timestamp_micros((F.lit(1_700_000_000) + F.col("page_id")) * 1_000_000 + F.col("page_id") % 3 * 250)
    return b.table(spark, sf, "pages").select("page_id", keys.item_id(F.col("url"), ts).alias("item_id"))


@query("SELECT text, min(doc_id) AS doc_id, arg_min(source, doc_id) AS source FROM documents GROUP BY text")
def raw_dedup_first(spark, sf):
    """Texts are told apart by a digest, so that no long key is sorted."""
    rows = b.table(spark, sf, "documents").withColumn("digest", F.sha2("text", 256))
    return dedup.first_wins(rows, ["digest"], F.col("doc_id")).select("text", "doc_id", "source")


@query("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def events_last_wins(spark, sf):
    return dedup.last_wins(b.table(spark, sf, "events"), ["user_id"], "event_id").select("user_id", "event_id", "event_type")


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'new' ELSE c_mktsegment END AS c_mktsegment FROM customer UNION ALL SELECT -1 - c_custkey, 'new' FROM customer WHERE c_custkey % 3 = 0")
def upsert_by_key(spark, sf):
    old = b.table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    third = old.where("c_custkey % 3 = 0").select("c_custkey", F.lit("new").alias("c_mktsegment"))
    return dedup.upsert(old, third.unionByName(third.withColumn("c_custkey", F.lit(-1) - F.col("c_custkey"))), ["c_custkey"])


@query("SELECT 2 * c_custkey AS c_custkey, c_mktsegment FROM customer UNION ALL SELECT 3 * c_custkey, 'absent' FROM customer WHERE 3 * c_custkey NOT IN (SELECT 2 * c_custkey FROM customer)")
def insert_absent(spark, sf):
    """Rows with keys of 2 and of 3 times the customer's, some of which are the same."""
    c = b.table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    times = lambda n: F.lit(n) * F.col("c_custkey")
    return dedup.insert_absent(c.withColumn("c_custkey", times(2)), c.select(times(3).alias("c_custkey"), F.lit("absent").alias("c_mktsegment")), ["c_custkey"])


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 'patched' ELSE s_name END AS s_name, s_nationkey FROM supplier")
def patch_rows(spark, sf):
    s = b.table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return dedup.patch(s, s.where("s_suppkey % 4 = 0").select("s_suppkey", F.lit("patched").alias("s_name"), F.lit(None).cast("int").alias("s_nationkey")), "s_suppkey")


CLIENTS = "c AS (SELECT c_custkey AS place, CAST(c_custkey AS VARCHAR) AS id, 'N' || c_nationkey AS customer_id, c_acctbal FROM customer)"
WANTED = "a AS (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN CAST(o_custkey AS VARCHAR) WHEN 1 THEN 'N' || (o_custkey % 40) ELSE 'X' || o_custkey END AS key FROM orders)"
MEANT = "m AS (SELECT a.o_orderkey, a.key, min(c.place) AS place FROM a LEFT JOIN (SELECT id AS value, place FROM c UNION ALL SELECT customer_id, place FROM c) c ON c.value = a.key GROUP BY ALL)"


def clients(spark, sf):
    """Customers by number and, not unique, by nation."""
    return b.table(spark, sf, "customer").select(F.col("c_custkey").alias("place"), F.col("c_custkey").cast("string").alias("id"), F.concat(F.lit("N"), "c_nationkey").alias("customer_id"), "c_acctbal")


def wanted(spark, sf):
    turn, cust = F.col("o_orderkey") % 3, F.col("o_custkey")
    key = F.when(turn == 0, cust.cast("string")).when(turn == 1, F.concat(F.lit("N"), cust % 40)).otherwise(F.concat(F.lit("X"), cust))
    return b.table(spark, sf, "orders").select("o_orderkey", key.alias("key"))


@query(f"WITH {CLIENTS}, {WANTED}, {MEANT} SELECT o_orderkey, key, c.id AS found_id, c.c_acctbal AS balance, CASE WHEN m.place IS NULL THEN 'Customer not found: ' || key END AS error FROM m LEFT JOIN c ON c.place = m.place")
def records_fetched(spark, sf):
    got = records.fetched(wanted(spark, sf), "key", clients(spark, sf), ["id", "customer_id"], "Customer")
    return got.select("o_orderkey", "key", F.col("row.id").alias("found_id"), F.col("row.c_acctbal").alias("balance"), "error")


@query(
    f"""WITH {CLIENTS}, {WANTED}, {MEANT}, p AS (SELECT place, max(o_orderkey) AS turn, max(o_orderkey) FILTER (o_orderkey % 2 = 0) AS note FROM m WHERE place IS NOT NULL GROUP BY place)
SELECT c.place, id, c_acctbal, note, turn IS NOT NULL AS changed FROM c LEFT JOIN p ON p.place = c.place"""
)
def records_updated(spark, sf):
    """Many patches of one row, by either id: of each column the last value counts."""
    patches = wanted(spark, sf).select("key", F.col("o_orderkey").alias("turn"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey")).alias("note"))
    out, _ = records.updated(patches, "key", clients(spark, sf), ["id", "customer_id"], "Customer", F.lit("2026-01-01").cast("timestamp"))
    return out.select("place", "id", "c_acctbal", "note", F.col("updated_date").isNotNull().alias("changed"))


@query(f"WITH {CLIENTS}, {WANTED}, {MEANT} SELECT 'answer' AS part, o_orderkey AS number, place IS NOT NULL AS deleted, CAST(place AS VARCHAR) AS id FROM m UNION ALL SELECT 'left', place, false, id FROM c WHERE place NOT IN (SELECT place FROM m WHERE place IS NOT NULL)")
def records_deleted(spark, sf):
    left, answers = records.deleted(wanted(spark, sf), "key", clients(spark, sf), ["id", "customer_id"])
    return answers.select(F.lit("answer").alias("part"), F.col("o_orderkey").alias("number"), "deleted", "id").unionByName(left.select(F.lit("left").alias("part"), F.col("place").alias("number"), F.lit(False).alias("deleted"), "id"))


@query(
    """WITH r AS (SELECT o_orderkey AS place, CAST(o_orderkey // 3 AS VARCHAR) AS candidate_id, 'M' || o_custkey AS matter_id, o_orderdate FROM orders),
one AS (SELECT candidate_id, place FROM r QUALIFY row_number() OVER (PARTITION BY candidate_id ORDER BY o_orderdate DESC, place) = 1), two AS (SELECT matter_id, place FROM r QUALIFY row_number() OVER (PARTITION BY matter_id ORDER BY o_orderdate DESC, place) = 1),
a AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey * 16 AS VARCHAR) ELSE '' END AS candidate, 'M' || c_custkey AS matter FROM customer)
SELECT c_custkey, coalesce(one.place, two.place) AS place FROM a LEFT JOIN one ON one.candidate_id = a.candidate LEFT JOIN two ON two.matter_id = a.matter"""
)
def records_prioritized(spark, sf):
    """By candidate, else by matter; the newest of each."""
    rows = b.table(spark, sf, "orders").select(F.col("o_orderkey").alias("place"), F.expr("cast(o_orderkey div 3 as string)").alias("candidate_id"), F.concat(F.lit("M"), "o_custkey").alias("matter_id"), F.col("o_orderdate").alias("created_date"))
    key = F.col("c_custkey")
    asked = b.table(spark, sf, "customer").select("c_custkey", F.when(key % 2 == 0, (key * 16).cast("string")).otherwise("").alias("candidate"), F.concat(F.lit("M"), key).alias("matter"))
    return records.prioritized(asked, rows, [("candidate", "candidate_id"), ("matter", "matter_id")]).select("c_custkey", "place")


@query("SELECT p_name, 'SRC-RSS-' || trim(regexp_replace(upper(p_name), '[^A-Z0-9]+', '-', 'g'), '-') AS source_id, trim(regexp_replace(lower(strip_accents(p_name)), '[^a-z0-9]+', '-', 'g'), '-') AS slug, count(*) AS n FROM part GROUP BY p_name")
def feed_slug_ids(spark, sf):
    rows = b.table(spark, sf, "part").groupBy("p_name").agg(F.count(F.lit(1)).alias("n"))
    return rows.select("p_name", text.upper_slug(F.col("p_name"), "SRC-RSS-").alias("source_id"), text.slug(F.col("p_name")).alias("slug"), "n")


@query("SELECT doc_id, sha256(lower(strip_accents(text))) AS folded, sha256(trim(regexp_replace(lower(strip_accents(text)), '[^a-z0-9]+', ' ', 'g'))) AS words FROM documents")
def fold_texts(spark, sf):
    """Whole texts, of which digests are compared."""
    whole = F.col("text")
    return b.table(spark, sf, "documents").select("doc_id", F.sha2(text.fold(whole), 256).alias("folded"), F.sha2(text.fold_words(whole), 256).alias("words"))


@query("SELECT o_orderkey, 'PR-CONTRACT-' || strftime(o_orderdate, '%Y%m%d') || '-' || lower(replace(o_orderpriority[3:], ' ', '-')) || '-' || o_custkey AS matter, lower('mat-' || o_custkey) || '::contract-record::' || o_orderkey AS key FROM orders")
def matter_keys(spark, sf):
    o = b.table(spark, sf, "orders")
    title = F.concat(F.expr("substring(o_orderpriority, 3)"), F.lit(" !"), "o_custkey")
    return o.select("o_orderkey", keys.matter_id(F.lit("contract"), title, F.col("o_orderdate").cast("string")).alias("matter"), keys.record_key(F.concat(F.lit("mat-"), "o_custkey"), F.lit("Contract record"), F.lit(""), F.col("o_orderkey").cast("string")).alias("key"))


# -- extraction --

AMOUNT_TEXT = [
    ("'US$' || k || '.5 million for works, $' || k || ' each'", "k * 1000000 + 500000"), ("k || ' millones de dólares y $1,' || lpad(CAST(k AS STRING), 3, '0')", "greatest(k * 1000000, 1000 + k)"),
    ("'€' || k || ' million'", "NULL"), ("'1.2 mil millones USD; $' || (1000 + k)", "1200000000"), ("'cost: $' || (5000 + k) || '.25'", "5000.25 + k"),
]
_text = "CASE o_orderkey % 5 " + " ".join(f"WHEN {i} THEN {t}" for i, (t, _) in enumerate(AMOUNT_TEXT)) + " END"
_amount = "CASE o_orderkey % 5 " + " ".join(f"WHEN {i} THEN {a}" for i, (_, a) in enumerate(AMOUNT_TEXT)) + " END"


@query(f"SELECT o_orderkey, CAST({_amount} AS DOUBLE) AS amount FROM (SELECT *, o_custkey % 900 + 1 AS k FROM orders)")
def money_max(spark, sf):
    rows = b.table(spark, sf, "orders").withColumn("k", F.col("o_custkey") % 900 + 1)
    return rows.select("o_orderkey", extract.headline_amount(F.expr(_text)).alias("amount"))


@query(
    """SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'Corp' || c_custkey || ' of Works' WHEN 1 THEN 'Acme' || c_custkey || ' JV' WHEN 2 THEN '' ELSE 'Node' || c_custkey END AS recipients,
CASE c_custkey % 4 WHEN 0 THEN 'award_announced' WHEN 2 THEN 'award_announced' WHEN 3 THEN 'rfp_open' END AS stage, CASE WHEN c_custkey % 4 = 1 THEN NULL ELSE 'procurement' END AS beat, CASE c_custkey % 4 WHEN 2 THEN 'FEMA' ELSE '' END AS agencies FROM customer"""
)
def recipients_extract(spark, sf):
    """Of each kind of sentence: who got the award, at what stage, through which agency."""
    key = F.col("c_custkey")
    body = F.when(key % 4 == 0, F.concat(F.lit("it was awarded to Corp"), key, F.lit(" of Works; awarded to CORP"), key, F.lit(" OF WORKS")))
    body = body.when(key % 4 == 1, F.concat(F.lit("work by Acme"), key, F.lit(" JV, then"))).when(key % 4 == 2, "aviso de adjudicación: awarded to FEMA").otherwise("a request for proposals")
    source = F.concat(F.lit("Node"), key)
    title = F.when(key % 4 == 3, F.concat(F.lit("from "), source)).otherwise("news")
    whole = F.concat(title, F.lit(" "), body)
    return b.table(spark, sf, "customer").select("c_custkey", F.array_join(extract.recipients(title, body, source), ",").alias("recipients"), extract.stage(whole).alias("stage"), extract.beat(whole).alias("beat"), F.array_join(agencies(whole), ",").alias("agencies"))


# texts between tags are stripped and joined; what the table's pages leave unfinished at their end is cut off
@query(r"""WITH c AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?is)<!--.*?-->|<(?:script|style)\b.*?</(?:script|style)>', '<!>', 'g'), '<[^>]*$', '') AS html FROM pages),
a AS (SELECT page_id, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title, CASE WHEN html LIKE '%<article>%' THEN regexp_extract(html, '(?s)<article>(.*?)(?:</article>|$)', 1) ELSE html END AS html FROM c),
p AS (SELECT page_id, title, list_transform(string_split(html, '<p>')[2:31], lambda x: string_split_regex(string_split_regex(x, '</(?:p|article|div|section|body|html)>')[1], '<[^>]*>')) AS parts FROM a),
s AS (SELECT page_id, title, list_aggregate(list_transform(parts, lambda x: coalesce(list_aggregate(list_filter(list_transform(x, lambda y: trim(y, E' \t\n\r\x0b\x0c')), lambda y: y <> ''), 'string_agg', ' '), '')), 'string_agg', ' ') AS body FROM p),
u AS (SELECT page_id, unnest([{'part': 'title', 'text': trim(title)}, {'part': 'body', 'text': coalesce(body, '')}], recursive := true) FROM s),
e AS (SELECT page_id, part, regexp_replace(replace(replace(replace(replace(replace(text, '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g') AS text FROM u)
SELECT page_id, max(text) FILTER (part = 'title') AS title, max(text) FILTER (part = 'body') AS body FROM e GROUP BY page_id""")
def html_title_paragraphs(spark, sf):
    return b.table(spark, sf, "pages").select("page_id", pages.page_texts(F.col("html")).alias("t")).select("page_id", "t.title", "t.body")


# -- ledger and streams --


@query(
    f"""{b.BASE} SELECT 'SIG-' || item_id AS signal_id, lower(labels[1]) || '_signal' AS signal_type, title, substr(body_text, 1, 500) AS summary,
CASE WHEN source_name = 'src1' THEN 'KNOWN-1' ELSE 'SRC-RSS-' || upper(source_name) END AS source_id, captured_at, lower(labels[1]) AS beat, CAST(printf('%.1f', CAST(confidence AS DOUBLE) * 100) AS DOUBLE) AS confidence_score, array_to_string(labels, ',') AS labels FROM classified"""
)
def signal_projection(spark, sf):
    known = spark.createDataFrame([("src1", "KNOWN-1")], "source_name string, source_id string")
    rows = ledger.to_signals(classify.classify(b.items(spark, sf), b.DOMAINS), known)
    return rows.select("signal_id", "signal_type", "title", "summary", "source_id", "captured_at", "beat", "confidence_score", joined("labels"))


@query(f"{b.BASE} SELECT item_id, CASE WHEN title = '' THEN '(untitled signal)' ELSE title END AS title, substr(body_text, 1, 500) AS body_text, upper(source_name[1]) || source_name[2:] AS source_name, confidence, array_to_string(labels, ',') AS labels FROM classified")
def signals_to_items(spark, sf):
    rows = ledger.to_items(ledger.to_signals(classify.classify(b.items(spark, sf), b.DOMAINS)))
    return rows.select("item_id", "title", "body_text", "source_name", "confidence", joined("labels"))


@query(f"{b.BASE} SELECT lower(labels[1]) AS beat, count(*) AS n FROM classified GROUP BY 1")
def beat_counts(spark, sf):
    return ledger.to_signals(classify.classify(b.items(spark, sf), b.DOMAINS)).groupBy("beat").agg(F.count(F.lit(1)).alias("n")).orderBy("beat")


def parts(spark, sf):
    return ledger.streams(b.signals(spark, sf), b.registry(spark, sf), F.lit("2026-01-01 00:00:00").cast("timestamp"))


@query(f"WITH {b.SIGNALS}, f AS (SELECT src, arg_min(source_id, line) AS ref, arg_min(confidence, line) AS confidence, arg_min(captured_at, line) AS created_at FROM ids GROUP BY src) SELECT src AS source_id, coalesce(nullif(family, ''), 'unknown') AS source_type, coalesce(nullif(name, ''), f.ref) AS source_name, f.ref AS source_ref, confidence, created_at FROM f LEFT JOIN reg ON f.ref = reg.ref")
def stream_sources(spark, sf):
    return parts(spark, sf)["sources"].select("source_id", "source_type", "source_name", "source_ref", "confidence", "created_at")


ENTITIES = f"""m AS (SELECT line, 0 AS k, ent AS entity_id, src AS source_id, coalesce(title, matter_id) AS name, 'public_matter' AS entity_type, confidence FROM ids
UNION ALL SELECT line, 1, {b.sql_fid('ent', "'agency'", b.sql_norm('agency'))}, src, agency, 'agency', confidence FROM ids
UNION ALL SELECT line, 2, {b.sql_fid('ent', "'municipality'", b.sql_norm('municipality'))}, src, municipality, 'municipality', 0.95 FROM ids WHERE municipality IS NOT NULL)"""


@query(f"WITH {b.SIGNALS}, {ENTITIES}, r AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY line, k) AS rn FROM m) SELECT entity_id, source_id, name, {b.sql_norm('name')} AS normalized_name, entity_type, confidence FROM r WHERE rn = 1")
def stream_entities(spark, sf):
    return parts(spark, sf)["entities"].select("entity_id", "source_id", "name", "normalized_name", "entity_type", "confidence")


@query(
    f"""WITH {b.SIGNALS}, e AS (SELECT line, ent, src, confidence, 'involves_agency' AS rel, {b.sql_fid('ent', "'agency'", b.sql_norm('agency'))} AS other FROM ids
UNION ALL SELECT line, ent, src, confidence, 'located_in', {b.sql_fid('ent', "'municipality'", b.sql_norm('municipality'))} FROM ids WHERE municipality IS NOT NULL),
k AS (SELECT *, {b.sql_fid('rel', 'ent', 'rel', 'other')} AS id FROM e), r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY line) AS rn FROM k)
SELECT id AS relationship_id, src AS source_id, ent AS source_entity_id, other AS target_entity_id, rel AS relationship_type, confidence FROM r WHERE rn = 1"""
)
def stream_relationships(spark, sf):
    return parts(spark, sf)["relationships"].select("relationship_id", "source_id", "source_entity_id", "target_entity_id", "relationship_type", "confidence")


@query(f"WITH {b.SIGNALS}, r AS (SELECT *, row_number() OVER (PARTITION BY signal_id ORDER BY line DESC) AS rn FROM ids) SELECT {b.sql_fid('obs', chr(39) + 'signal' + chr(39), 'signal_id')} AS observation_id, ent AS entity_id, src AS source_id, signal_type AS observation_type, captured_at AS observed_at, title, beat, confidence FROM r WHERE rn = 1")
def stream_observations(spark, sf):
    return parts(spark, sf)["observations"].select("observation_id", "entity_id", "source_id", "observation_type", "observed_at", "attributes.title", "attributes.beat", "confidence")


# -- joins and look-ups --


@query("SELECT s_suppkey, coalesce(CASE WHEN n_nationkey % 5 = 0 THEN NULL WHEN n_nationkey % 5 = 1 THEN NULL ELSE n_name END, 'unknown') AS n_name, CAST(coalesce(n_regionkey, -1) AS VARCHAR) AS n_regionkey FROM supplier LEFT JOIN nation ON s_nationkey = CASE WHEN n_nationkey % 6 = 5 THEN -n_nationkey ELSE n_nationkey END")
def registry_left_join_default(spark, sf):
    """Some nations go by a key that no supplier names."""
    n, key = b.table(spark, sf, "nation"), F.col("n_nationkey")
    name = F.when(key % 5 == 0, "").when(key % 5 != 1, F.col("n_name"))
    dimension = n.select(F.when(key % 6 == 5, -key).otherwise(key).cast("int").alias("s_nationkey"), name.alias("n_name"), "n_regionkey")
    rows = lookup.with_defaults(b.table(spark, sf, "supplier"), dimension, "s_nationkey", {"n_name": F.lit("unknown"), "n_regionkey": F.lit("-1")})
    return rows.select("s_suppkey", "n_name", "n_regionkey")


@query("SELECT c_custkey, coalesce(string_agg(o_orderkey, ',' ORDER BY o_orderkey), '') AS orders, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey")
def nested_signals(spark, sf):
    o = b.table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderstatus")
    rows = lookup.nested(b.table(spark, sf, "customer").select("c_custkey"), o, "c_custkey", "orders")
    return rows.select("c_custkey", F.array_join(F.transform("orders", lambda x: x["o_orderkey"].cast("string")), ",").alias("orders"), F.size("orders").cast("long").alias("n"))


_old_text = "sha256(text || CASE WHEN doc_id % 3 = 0 THEN '#' ELSE '' END)"


@query(f"WITH d AS (SELECT *, {_old_text} AS old_digest FROM documents), k AS (SELECT old_digest, min(doc_id) AS m FROM d GROUP BY 1), s AS (SELECT source, n_chars, min(doc_id) AS m FROM documents WHERE n_chars > 100 GROUP BY ALL) SELECT doc_id, coalesce(k.m, s.m) AS duplicate_of FROM documents LEFT JOIN k ON old_digest = sha256(text) LEFT JOIN s USING (source, n_chars)")
def duplicate_guard(spark, sf):
    """All documents against all, some of which are spelled so on the other side that their text can't match."""
    d = b.table(spark, sf, "documents").select("doc_id", "text", "source", "n_chars")
    spelled = F.concat("text", F.when(F.col("doc_id") % 3 == 0, "#").otherwise(""))
    left, right = d.withColumn("digest", F.sha2("text", 256)), d.select(F.col("doc_id").alias("old"), "source", "n_chars", F.sha2(spelled, 256).alias("digest"))
    rows = lookup.first_match(left, right, [(["digest"], None), (["source", "n_chars"], F.col("n_chars") > 100)], "old", "duplicate_of")
    return rows.select("doc_id", "duplicate_of")


@query("SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT CASE WHEN c_custkey % 7 = 0 THEN -c_custkey ELSE c_custkey END FROM customer)")
def registry_anti(spark, sf):
    key = F.col("c_custkey")
    known = b.table(spark, sf, "customer").select(F.when(key % 7 == 0, -key).otherwise(key).alias("o_custkey"))
    return lookup.missing_references(b.table(spark, sf, "orders"), known, "o_custkey")


#: Of three customers one is a place of its own, one shares its name with its neighbours, and one is never asked for.
GAZETTEER = "f AS (SELECT c_custkey AS id, CASE c_custkey % 3 WHEN 0 THEN 'rio ' || c_custkey WHEN 1 THEN 'lago ' || (c_custkey // 10) ELSE 'monte ' || c_custkey END AS key FROM customer), i AS (SELECT key, count(*) AS n, min(id) AS id FROM f GROUP BY 1)"


@query(f"WITH {GAZETTEER} SELECT o_orderkey, CASE WHEN n IS NULL THEN 'unresolved' WHEN n > 1 THEN 'collision_review_required' ELSE 'resolved' END AS resolution_status, CASE WHEN n = 1 THEN id END AS canonical_id, CASE WHEN n > 1 THEN n END AS candidate_count FROM orders LEFT JOIN i ON key = CASE o_orderkey % 3 WHEN 0 THEN 'rio ' || o_custkey WHEN 1 THEN 'lago ' || (o_custkey // 10) ELSE 'nowhere ' || o_custkey END")
def gazetteer_resolve(spark, sf):
    key = F.col("c_custkey")
    name = F.when(key % 3 == 0, F.concat(F.lit("Río "), key)).when(key % 3 == 1, F.concat(F.lit("Lago "), F.floor(key / 10))).otherwise(F.concat(F.lit("Monte "), key))
    features = b.table(spark, sf, "customer").select(key.alias("canonical_id"), name.alias("canonical_name"), F.upper(name).alias("normalized_name"), F.lit("river").alias("feature_type"), F.lit("hydro").alias("group"))
    of, at = F.col("o_orderkey") % 3, F.col("o_custkey")
    place = F.when(of == 0, F.concat(F.lit(" RIO--"), at)).when(of == 1, F.concat(F.lit("Lágo "), F.floor(at / 10))).otherwise(F.concat(F.lit("nowhere "), at))
    o = b.table(spark, sf, "orders").select("o_orderkey", place.alias("place"))
    return lookup.resolve_places(o, features, "place").select("o_orderkey", "resolution_status", "canonical_id", "candidate_count")


# -- search and order --


@query("SELECT p_partkey, p_name, p_brand FROM part WHERE contains(lower(p_name), 'red') OR contains(lower(p_brand), 'red') OR contains(lower(p_type), 'red')")
def text_search(spark, sf):
    return search.text_search(b.table(spark, sf, "part"), "  ReD ", ["p_name", "p_brand", "p_type"]).select("p_partkey", "p_name", "p_brand")


@query("SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '5-LOW')")
def criteria_filter(spark, sf):
    return search.criteria(b.table(spark, sf, "orders"), {"o_orderstatus": "F", "o_orderpriority": ["1-URGENT", "5-LOW"]}).select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query("SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS score FROM customer ORDER BY score DESC NULLS LAST, c_custkey LIMIT 200")
def sorted_page(spark, sf):
    rows = b.table(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 5 != 0, F.col("c_acctbal")).alias("score"))
    return search.page(rows, "-score", "c_custkey", 200)


# -- lifecycle and entities --

MATTER_TRIGGERS = "CASE WHEN c_custkey % 11 = 0 THEN 'contract_awarded' ELSE 'rumour' END"


def matters(spark, sf):
    key = F.col("c_custkey")
    stage = F.when(key % 13 == 0, "officialized").when(key % 13 == 1, "no_such_stage").otherwise("public_signal")
    none = F.array().cast("array<string>")
    return b.table(spark, sf, "customer").select(
        F.concat(F.lit("MAT-"), key).alias("matter_id"), F.col("c_name").alias("title"), F.lit("contract").alias("matter_type"), stage.alias("status_lifecycle"), F.expr(f"array({MATTER_TRIGGERS})").alias("handoff_triggers"),
        F.when(key % 17 == 0, F.concat(F.lit("ID-"), key)).otherwise("").alias("official_identifier"), F.lit(None).cast("string").alias("official_source_url"), F.col("c_acctbal").alias("confidence_score"), F.lit(None).cast("double").alias("amount_confirmed"),
        F.array("c_mktsegment").alias("agencies"), none.alias("organizations"), none.alias("record_ids"), F.lit("").alias("sync_status"), F.lit(None).cast("string").alias("last_handoff_candidate_id"), F.lit(None).cast("timestamp").alias("first_seen_at"),
    )


def matter_signals(spark, sf):
    o = b.table(spark, sf, "orders")
    trigger = F.when(F.col("o_orderkey") % 50 == 0, F.array(F.lit("payment_issued"))).otherwise(F.array().cast("array<string>"))
    return o.select(F.concat(F.lit("SIG-"), "o_orderkey").alias("signal_id"), F.concat(F.lit("MAT-"), "o_custkey").alias("matter_id"), trigger.alias("handoff_triggers"), F.lit("raw").alias("handoff_status"))


READY = f"rd AS (SELECT c_custkey, c_name, c_mktsegment, {MATTER_TRIGGERS} = 'contract_awarded' OR c_custkey % 17 = 0 OR c_custkey % 13 = 0 OR c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderkey % 50 = 0) AS ready FROM customer)"


@query(f"WITH {READY} SELECT 'MAT-' || c_custkey AS matter_id, ready AS is_ready, CASE WHEN ready THEN 'ready' ELSE 'watching' END AS badge FROM rd")
def handoff_ready(spark, sf):
    rows = lifecycle.ready(matters(spark, sf), matter_signals(spark, sf))
    return rows.select("matter_id", "is_ready", lifecycle.badge(F.col("is_ready")).alias("badge"))


def store(spark, sf):
    m = matters(spark, sf)
    candidates = m.where("matter_id like '%7'").select(F.concat(F.lit("C-"), "matter_id").alias("candidate_id"), "matter_id", "title", F.lit("ready_for_review").alias("status"), F.lit("").alias("target_record_type"), F.lit("").alias("trigger_summary"), F.array().cast("array<string>").alias("linked_signal_ids"), F.lit(0.0).alias("confidence_score"), F.lit(None).cast("string").alias("record_id"), F.lit(None).cast("string").alias("reviewer_note"))
    records = m.where("matter_id like '%77'").select(F.concat(F.lit("R-"), "matter_id").alias("record_id"), "matter_id", F.lit("contract_record").alias("record_type"), "title", "official_identifier", F.lit("").alias("official_source_url"), "amount_confirmed", F.col("agencies").alias("parties"), F.array(F.lit("SIG-old")).alias("linked_signal_ids"), F.lit("").alias("linked_candidate_id"), F.lit("").alias("sync_status"))
    records = records.withColumn("canonical_key", keys.record_key(F.col("matter_id"), F.col("record_type"), F.col("official_identifier"), F.col("official_source_url"), F.col("title")))
    return {"matters": m, "signals": matter_signals(spark, sf), "candidates": candidates, "records": records}


NOW = "timestamp'2026-01-01 00:00:00'"


@query(f"WITH {READY}, s AS (SELECT 'MAT-' || o_custkey AS matter_id, count(*) AS n FROM orders GROUP BY 1), a AS (SELECT 'MAT-' || c_custkey AS matter_id, {MATTER_TRIGGERS} AS t FROM rd JOIN customer USING (c_custkey) WHERE ready AND NOT (('MAT-' || c_custkey) LIKE '%7')) SELECT 'handoff-' || matter_id || '-1767225600000' AS candidate_id, matter_id, 'ready_for_review' AS status, t AS trigger_summary, coalesce(n, 0) AS n_signals FROM a LEFT JOIN s USING (matter_id) UNION ALL SELECT 'C-MAT-' || c_custkey, 'MAT-' || c_custkey, 'ready_for_review', '', 0 FROM customer WHERE ('MAT-' || c_custkey) LIKE '%7'")
def handoff_evaluate(spark, sf):
    return lifecycle.evaluate(store(spark, sf), F.expr(NOW))["candidates"].select("candidate_id", "matter_id", "status", "trigger_summary", F.size("linked_signal_ids").cast("long").alias("n_signals"))


@query("WITH m AS (SELECT 'MAT-' || c_custkey AS matter_id, c_custkey AS k FROM customer WHERE ('MAT-' || c_custkey) LIKE '%7'), s AS (SELECT 'MAT-' || o_custkey AS matter_id, count(*) AS n FROM orders GROUP BY 1) SELECT matter_id, CASE WHEN matter_id LIKE '%77' THEN 'R-' || matter_id ELSE 'record-' || matter_id || '-1767225600000' END AS record_id, CASE WHEN matter_id LIKE '%77' THEN 'linked_existing' ELSE 'created_local' END AS sync_status, coalesce(n, 0) + CASE WHEN matter_id LIKE '%77' THEN 1 ELSE 0 END AS n_signals FROM m LEFT JOIN s USING (matter_id)")
def handoff_accept(spark, sf):
    s = store(spark, sf)
    done = lifecycle.accept(s, s["candidates"].select("candidate_id"), F.expr(NOW))
    return done["records"].select("matter_id", "record_id", "sync_status", F.size("linked_signal_ids").cast("long").alias("n_signals"))


@query("SELECT 'C-MAT-' || c_custkey AS candidate_id, 'rejected' AS status, CASE WHEN c_custkey % 20 = 7 THEN 'Rejected.' ELSE 'no' END AS reviewer_note FROM customer WHERE ('MAT-' || c_custkey) LIKE '%7'")
def handoff_reject(spark, sf):
    s = store(spark, sf)
    note = F.when(F.substring_index("candidate_id", "-", -1).cast("long") % 20 == 7, "").otherwise("no")
    return lifecycle.reject(s, s["candidates"].select("candidate_id", note.alias("reviewer_note")))["candidates"].select("candidate_id", "status", "reviewer_note")


@query(
    "WITH m AS (SELECT 'MAT-' || c_custkey AS matter_id, c_custkey AS k, c_name FROM customer) SELECT matter_id, CASE WHEN matter_id LIKE '%77' THEN 'R-' || matter_id ELSE 'S-' || k END AS record_id, CASE WHEN matter_id LIKE '%77' THEN 'updated_from_sync' ELSE 'created_from_sync' END AS sync_status, k * 1.5::DOUBLE AS amount_confirmed, CASE WHEN matter_id LIKE '%77' THEN 'SIG-old' ELSE '' END AS signals FROM m"
)
def handoff_sync(spark, sf):
    """A record from elsewhere for every matter: it updates the one that is there, or is new."""
    s = store(spark, sf)
    key = F.substring_index("matter_id", "-", -1).cast("long")
    new = s["matters"].select(F.concat(F.lit("S-"), key).alias("record_id"), "matter_id", F.lit("contract_record").alias("record_type"), "official_identifier", F.lit("").alias("official_source_url"), "title", (key * 1.5).alias("amount_confirmed"), F.lit(None).cast("array<string>").alias("linked_signal_ids"))
    done = lifecycle.sync(s, new, F.expr(NOW))["records"]
    return done.select("matter_id", "record_id", "sync_status", "amount_confirmed", F.array_join(F.coalesce("linked_signal_ids", F.array().cast("array<string>")), ",").alias("signals"))


@query(
    "SELECT (SELECT count(*) FROM orders) AS signals, (SELECT count(*) FROM customer) AS matters, (SELECT count(*) FROM customer WHERE ('MAT-' || c_custkey) LIKE '%7') AS ready, (SELECT count(*) FROM orders WHERE o_totalprice >= 85) AS high_confidence, (SELECT count(*) FROM supplier WHERE s_suppkey % 4 IN (0, 1, 2)) AS stale_sources"
)
def monitor_metrics(spark, sf):
    price = b.table(spark, sf, "orders").select(F.concat(F.lit("SIG-"), "o_orderkey").alias("signal_id"), F.col("o_totalprice").alias("confidence_score"), F.lit("raw").alias("handoff_status"))
    status = F.element_at(F.array(*map(F.lit, ["broken", "stale", "manual", "fine"])), (F.col("s_suppkey") % 4 + 1).cast("int"))
    sources = b.table(spark, sf, "supplier").select(F.col("s_name").alias("name"), status.alias("status"))
    return views.monitor(store(spark, sf) | {"signals": price, "sources": sources})


@query("WITH s AS (SELECT o_custkey, count(*) AS n, count(DISTINCT o_orderpriority) AS c FROM orders GROUP BY 1) SELECT 'MAT-' || c_custkey AS matter_id, coalesce(n, 0) AS n_signals, coalesce(c, 0) AS n_sources, CASE WHEN ('MAT-' || c_custkey) LIKE '%77' THEN 1 ELSE 0 END AS n_records FROM customer LEFT JOIN s ON o_custkey = c_custkey")
def matter_counts(spark, sf):
    s = store(spark, sf)
    signals = b.table(spark, sf, "orders").select(F.concat(F.lit("MAT-"), "o_custkey").alias("matter_id"), F.col("o_orderpriority").alias("source_id"))
    return views.matter_counts(s | {"signals": signals})


# -- written and read again --


@query(f"{b.BASE} SELECT item_id, unnest({b.sql_targets(v.TARGETS, v.HUB)}) AS target FROM classified WHERE confidence >= 0.55")
def payloads_written(spark, sf):
    """Payloads written by target, and read back from there."""
    rows = classify.described(b.items(spark, sf), b.DOMAINS, urgent=b.URGENT, water=b.DOMAINS)
    path = scratch(spark)
    sinks.write_payloads(routing.payloads(routing.fan_out(rows), F.expr(NOW)), path)
    back = readers.outbound(spark, path)
    return back.select(F.get_json_object("payload", "$.item_id").alias("item_id"), "target")


@query(f"WITH {b.SIGNALS} SELECT line, signal_id, title, captured_at, coalesce(municipality, '') AS municipalities, round(o_totalprice % 100, 0) AS confidence_score FROM sig JOIN orders ON o_orderkey = line")
def ledger_read_back(spark, sf):
    """Signals written as a ledger, to which lines are added that are no JSON, and read back by a tolerant scan. Their titles end in their line."""
    path = scratch(spark)
    signals = b.signals(spark, sf)
    sinks.write_ledger(signals.withColumn("title", F.concat_ws("|", "title", "line")).drop("line"), path)
    b.table(spark, sf, "nation").select(F.concat(F.lit('{"signal_id": "cut off '), "n_name").alias("value")).write.mode("append").text(path)
    back = readers.ledger(spark, path, strict=False)
    line = F.element_at(F.split("title", r"\|"), -1).cast("long")
    return back.select(line.alias("line"), "signal_id", F.split("title", r"\|")[0].alias("title"), "captured_at", F.array_join("municipalities", ",").alias("municipalities"), "confidence_score")


@query("SELECT 'S-' || s_suppkey AS source_id, CASE WHEN s_suppkey % 3 = 0 THEN 'again, ' || s_name ELSE s_name END AS name, CASE WHEN s_suppkey % 3 = 0 THEN 'es' ELSE 'en' END AS language, s_acctbal AS reliability_default FROM supplier")
def registry_csv_read_back(spark, sf):
    """A registry written as CSV in which a third of the sources stand twice; of these the later row counts."""
    s, path = b.table(spark, sf, "supplier"), scratch(spark)
    row = lambda turn, name, language: F.struct(F.lit(turn).alias("turn"), name.alias("name"), F.lit(language).alias("language"))
    turns = F.when(F.col("s_suppkey") % 3 == 0, F.array(row(0, F.col("s_name"), "en"), row(1, F.concat(F.lit("again, "), "s_name"), "es"))).otherwise(F.array(row(0, F.col("s_name"), "en")))
    rows = s.select(F.concat(F.lit("S-"), "s_suppkey").alias("source_id"), F.col("s_acctbal").alias("reliability_default"), F.inline(turns)).orderBy("turn", "source_id")
    empty = [F.lit(None).cast("string").alias(c) for c in ("scrape_method", "active", "notes")]
    rows.select("source_id", "name", "language", F.lit("family").alias("source_family"), "reliability_default", *empty).write.option("header", True).csv(path)
    return readers.source_registry(spark, path).select("source_id", "name", "language", "reliability_default")


@query(f"{b.BASE}, {STATES} SELECT item_id, coalesce(status, 'new') AS status FROM classified LEFT JOIN st ON item_id = sid")
def dispatches_upserted(spark, sf):
    """Records of all items, and then those of the labelled ones in their place."""
    path, records = scratch(spark), label_records(spark, sf)
    sinks.write_dispatches(b.items(spark, sf).select("item_id", F.lit("new").alias("status")), path, "1")
    return sinks.write_dispatches(records, path, "2").join(b.items(spark, sf).select("item_id"), "item_id", "left_semi").select("item_id", "status")


@query("SELECT c_custkey, CAST(row_number() OVER (ORDER BY c_custkey) - 1 AS BIGINT) AS line FROM customer")
def lines_numbered(spark, sf):
    """Lines of several files, numbered through in order of files."""
    path = scratch(spark)
    b.table(spark, sf, "customer").select("c_custkey", F.col("c_custkey").cast("string").alias("value")).repartitionByRange(7, "c_custkey").sortWithinPartitions("c_custkey").select("value").write.text(path)
    return readers.ledger_lines(spark, path).select(F.col("value").cast("long").alias("c_custkey"), "line")


@query(f"WITH {b.SIGNALS}, {ENTITIES} SELECT 'sources' AS stream, count(DISTINCT src) AS n FROM ids UNION ALL SELECT 'entities', count(DISTINCT entity_id) FROM m UNION ALL SELECT 'observations', count(DISTINCT signal_id) FROM ids")
def package_counts(spark, sf):
    """Streams written as a package; what its manifest says, and how many lines are there."""
    path, made = scratch(spark), parts(spark, sf)
    sinks.write_package({k: made[k] for k in ("sources", "entities", "observations")}, path, "production", "2026-01-01T00:00:00Z", "engine")
    said = spark.createDataFrame(list(sinks.stream_counts(sinks.read_manifest(spark, path)).items()), "stream string, said long")
    lines = [spark.read.text(f"{path}/{k}").agg(F.lit(k).alias("stream"), F.count(F.lit(1)).alias("n")) for k in ("sources", "entities", "observations")]
    return lines[0].union(lines[1]).union(lines[2]).join(said, "stream").where("n = said").select("stream", "n")


@query("SELECT c_custkey, CASE WHEN c_acctbal / 100 >= 95 THEN 'T1 confirmado' WHEN c_acctbal / 100 >= 85 THEN 'Oficial preliminar' WHEN c_acctbal / 100 >= 70 THEN 'Corroborado' WHEN c_acctbal / 100 >= 50 THEN 'Monitor' WHEN c_acctbal / 100 >= 30 THEN 'Débil' ELSE 'No publicar como hecho' END AS band FROM customer")
def confidence_bands(spark, sf):
    return b.table(spark, sf, "customer").select("c_custkey", keys.band(F.col("c_acctbal") / 100).alias("band"))


CLAIMS = ["rights reserved", "worthless", "ésen"]
_hits = "list_filter([" + ", ".join(f"CASE WHEN contains(t, '{c}') THEN '{o}' END" for c, o in (("rights reserved", "rights reserved"), ("worthless", "worthless"), ("esen", "ésen"))) + "], lambda x: x IS NOT NULL)"


@query(f"WITH d AS (SELECT doc_id, {_hits.replace('(t,', '(lower(strip_accents(text)),')} AS h FROM documents) SELECT doc_id, array_to_string(h, ',') AS matches, CASE WHEN len(h) = 0 THEN 'clean' WHEN doc_id % 2 = 0 THEN 'needs_review' ELSE 'blocked_official_claim' END AS status FROM d")
def language_guard(spark, sf):
    stage = F.when(F.col("doc_id") % 2 == 0, "officialized").otherwise("unheard_of")
    rows = b.table(spark, sf, "documents").select("doc_id", lifecycle.language_guard(F.col("text"), stage, CLAIMS).alias("g"))
    return rows.select("doc_id", F.array_join("g.blocked_matches", ",").alias("matches"), "g.status")


@query("WITH s AS (SELECT * FROM (VALUES ('raw_observation', 0), ('public_signal', 1), ('developing_matter', 2), ('pending_officialization', 3), ('officialized', 4), ('execution_amendment', 5), ('audit_dispute_impact', 6)) AS t(stage, o)) SELECT c_custkey, stage, o <= CASE WHEN c_custkey % 13 = 0 THEN 4 ELSE 1 END AS reached FROM customer CROSS JOIN s")
def stage_timeline(spark, sf):
    rows = lifecycle.timeline(matters(spark, sf).select(F.expr("substring(matter_id, 5)").cast("long").alias("c_custkey"), "status_lifecycle"))
    return rows.select("c_custkey", "stage", "reached")


def entity_mentions(spark, sf):
    s = b.signals(spark, sf).select("line", "signal_id", "agencies", F.col("municipalities").alias("entities"))
    none = F.array().cast("array<string>")
    m = b.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("line"), none.alias("agencies"), F.array("s_name", F.lit("  Líow ")).alias("people"), F.array(F.lit("??")).alias("organizations"))
    return entities.mentions(s, m)


@query(f"WITH {b.SIGNALS}, m AS (SELECT agency AS name, 'agency' AS type, signal_id, 0 AS part, line, 0 AS place FROM sig UNION ALL SELECT municipality, 'entity', signal_id, 0, line, 1 FROM sig WHERE municipality IS NOT NULL UNION ALL SELECT s_name, 'person', NULL, 1, s_suppkey, 1 FROM supplier UNION ALL SELECT 'Líow', 'person', NULL, 1, s_suppkey, 1.5 FROM supplier), k AS (SELECT *, replace({b.sql_norm('name')}, ' ', '-') AS slug FROM m) SELECT slug, arg_min(name, (part, line, place)) AS name, CASE WHEN bool_or(type = 'agency') THEN 'agency' ELSE arg_min(type, (part, line, place)) END AS type, count(*) AS mention_count, count(DISTINCT signal_id) AS n_signals FROM k WHERE slug <> '' GROUP BY slug")
def entity_rollup(spark, sf):
    rows = entities.profiles(entity_mentions(spark, sf))
    return rows.select("slug", "name", "type", "mention_count", "n_signals").orderBy(F.desc("mention_count"), "name")


@query(f"WITH r AS (WITH {b.SIGNALS}, m AS (SELECT agency AS name, 'agency' AS type, signal_id, 0 AS part, line, 0 AS place FROM sig UNION ALL SELECT municipality, 'entity', signal_id, 0, line, 1 FROM sig WHERE municipality IS NOT NULL UNION ALL SELECT s_name, 'person', NULL, 1, s_suppkey, 1 FROM supplier UNION ALL SELECT 'Líow', 'person', NULL, 1, s_suppkey, 1.5 FROM supplier), k AS (SELECT *, replace({b.sql_norm('name')}, ' ', '-') AS slug FROM m) SELECT slug, arg_min(name, (part, line, place)) AS name, CASE WHEN bool_or(type = 'agency') THEN 'agency' ELSE arg_min(type, (part, line, place)) END AS type, count(*) AS mention_count, count(DISTINCT signal_id) AS n_signals FROM k WHERE slug <> '' GROUP BY slug) SELECT row_number() OVER (ORDER BY mention_count DESC, icu_sort_key(name, 'und'), name, slug) - 1 AS place, slug, name, mention_count FROM r")
def entities_by_mentions(spark, sf):
    """The order itself: each profile's place."""
    return entities.by_mentions(entities.profiles(entity_mentions(spark, sf))).select("place", "slug", "name", "mention_count")


@query("SELECT row_number() OVER (ORDER BY icu_sort_key(left(text, 40), 'und'), left(text, 40), doc_id) - 1 AS place, doc_id FROM documents")
def titles_in_locale_order(spark, sf):
    """Documents by their first characters, with accents and case where people look for them."""
    rows = b.table(spark, sf, "documents").select("doc_id", F.substring("text", 1, 40).alias("title"))
    return search.placed(rows, search.by_locale(F.col("title")), F.col("title"), F.col("doc_id")).select("place", "doc_id")


@query(f"WITH {b.SIGNALS} SELECT line, signal_id FROM sig WHERE signal_id IN (SELECT signal_id FROM sig WHERE {b.sql_norm('agency')} = 'low')")
def entity_semi(spark, sf):
    return entities.signals_of(b.signals(spark, sf), entity_mentions(spark, sf), "low").select("line", "signal_id")


# -- sets, quality, scores and JSON --


@query("WITH e AS (SELECT user_id, list_sort(list_distinct(list(event_type) FILTER (event_id % 2 = 0))) AS a, list_sort(list_distinct(list(event_type) FILTER (event_id % 2 = 1))) AS c FROM events GROUP BY user_id) SELECT user_id, array_to_string(list_sort(list_distinct(list_concat(coalesce(a, []), coalesce(c, [])))), ',') AS both_sets, array_to_string(list_filter(coalesce(a, []), lambda x: NOT list_contains(coalesce(c, []), x)), ',') AS missing, array_to_string(list_filter(coalesce(a, []), lambda x: list_contains(coalesce(c, []), x)), ',') AS shared FROM e")
def set_ops_arrays(spark, sf):
    of = lambda r: F.array_sort(F.collect_set(F.when(F.col("event_id") % 2 == r, F.col("event_type"))))
    rows = b.table(spark, sf, "events").groupBy("user_id").agg(of(0).alias("a"), of(1).alias("c"))
    return rows.select("user_id", F.array_join(F.array_sort(F.array_union("a", "c")), ",").alias("both_sets"), F.array_join(F.array_except("a", "c"), ",").alias("missing"), F.array_join(F.array_intersect("a", "c"), ",").alias("shared"))


@query("SELECT l_orderkey, l_linenumber, array_to_string(list_filter([CASE WHEN l_discount > 0.08 THEN 'confidence' END, CASE WHEN l_returnflag = 'R' THEN 'evidence_tier' END], lambda x: x IS NOT NULL), ',') AS faults FROM lineitem WHERE l_discount > 0.08 OR l_returnflag = 'R'")
def dq_findings(spark, sf):
    rows = b.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.lit("x").alias("item_id"), F.when(F.col("l_discount") > 0.08, 1.5).otherwise(F.col("l_discount")).alias("confidence"), F.when(F.col("l_returnflag") == "R", "T9").otherwise("T1").alias("evidence_tier"), F.array(F.lit("l")).alias("labels"))
    return quality.quarantine(rows, quality.item_faults())[1].select("l_orderkey", "l_linenumber", F.array_join("faults", ",").alias("faults"))


@query("SELECT 'schema:events_' || CASE WHEN event_id % 4 IN (0, 1) THEN 'line_' || event_id ELSE 'missing_' || event_id END AS finding_id, CASE event_id % 4 WHEN 0 THEN 'line is not valid JSON' WHEN 1 THEN 'line is not a JSON object' ELSE 'row missing required fields' END AS message, event_id + 1 AS line FROM events WHERE event_id % 4 <> 3 AND event_id % 20 <> 0")
def ledger_findings(spark, sf):
    e = b.table(spark, sf, "events")
    value = F.when(F.col("event_id") % 20 == 0, "  ").when(F.col("event_id") % 4 == 0, "{bad").when(F.col("event_id") % 4 == 1, "[1]").when(F.col("event_id") % 4 == 2, F.col("props")).otherwise('{"signal_id": "s", "title": null}')
    found = quality.ledger_findings(e.select(F.col("event_id").alias("line"), value.alias("value")), ["signal_id", "title"], "events")
    return found.select("finding_id", "message", "line")


@query("SELECT count(*) AS cells, count(DISTINCT o_orderkey) AS distinct_ids, count(DISTINCT o_orderkey % 100) AS distinct_rows, count(DISTINCT o_orderkey // 100) AS distinct_columns, count(*) FILTER (o_orderkey % 100 > 89 OR o_orderkey // 100 > 9) AS out_of_range, count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS unknown_class, FALSE AS is_whole FROM orders")
def grid_coverage(spark, sf):
    cells = b.table(spark, sf, "orders").select(F.col("o_orderkey").alias("cell_id"), (F.col("o_orderkey") % 100).alias("row_index"), F.floor(F.col("o_orderkey") / 100).alias("column_index"), F.col("o_orderstatus").alias("classification"))
    return quality.grid_coverage(cells, 90, 10, ["F", "O"])


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark, sf):
    return b.table(spark, sf, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("SELECT event_id, CAST(printf('%.3f', value / 100) AS DOUBLE) AS confidence, least(greatest(value / 100, 0), 1) AS clamped FROM events")
def score_scales(spark, sf):
    e = b.table(spark, sf, "events")
    return e.select("event_id", keys.per_hundred(F.col("value")).alias("confidence"), keys.clamp(F.col("value") / 100).alias("clamped"))


@query(b.ORDER_FINDINGS)
def order_payload_findings(spark, sf):
    """What of nested payloads breaks a schema, with the path to it."""
    return schemas.with_findings(b.order_payloads(spark, sf), "payload", b.ORDER_SCHEMA).select("o_orderkey", F.inline("findings"))


@query("""WITH p AS (SELECT event_id, CASE WHEN event_id % 9 = 0 THEN left(props, length(props) - 1) WHEN event_id % 9 = 1 THEN '[' || props || ']' ELSE props END AS props, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
SELECT rule, path, count(*) AS n FROM (SELECT unnest(CASE WHEN event_id % 9 = 0 THEN [{'path': '$', 'rule': 'json'}] WHEN event_id % 9 = 1 THEN [{'path': '$', 'rule': 'type'}]
  WHEN k > 90 THEN [{'path': '$.k', 'rule': 'exclusiveMaximum'}, {'path': '$.j', 'rule': 'required'}] WHEN k = 90 THEN [{'path': '$.k', 'rule': 'exclusiveMaximum'}, {'path': '$.j', 'rule': 'required'}] ELSE [{'path': '$.j', 'rule': 'required'}] END, recursive := true) FROM p) GROUP BY ALL""")
def event_props_findings(spark, sf):
    """Findings on the events' JSON, some of which is cut off or wrapped in an array, by rule and path."""
    cut = F.when(F.col("event_id") % 9 == 0, F.expr("left(props, length(props) - 1)")).when(F.col("event_id") % 9 == 1, F.concat(F.lit("["), "props", F.lit("]"))).otherwise(F.col("props"))
    rows = b.table(spark, sf, "events").select(cut.alias("props"))
    schema = {"type": "object", "required": ["k", "j"], "properties": {"k": {"type": "integer", "minimum": 0, "exclusiveMaximum": 90}}}
    return schemas.with_findings(rows, "props", schema).select(F.inline("findings")).groupBy("rule", "path").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT o_orderkey, printf('%.2f', CAST(o_totalprice AS DOUBLE) / 8) AS shown, CAST(printf('%.2f', CAST(o_totalprice AS DOUBLE) / 8) AS DOUBLE) AS eighth, CAST(printf('%.1f', CAST(o_totalprice AS DOUBLE) / 7) AS DOUBLE) AS seventh,
CAST(printf('%.3f', CAST(o_totalprice AS DOUBLE) / -1000) AS DOUBLE) AS thousandth FROM orders""")
def rounded_exact(spark, sf):
    """Numbers of which many lie on, or next to, the middle of two places."""
    price = F.col("o_totalprice").cast("double")
    return b.table(spark, sf, "orders").select(
        "o_orderkey", numbers.fixed_exact(price / 8, 2).alias("shown"), numbers.round_exact(price / 8, 2).alias("eighth"), numbers.round_exact(price / 7, 1).alias("seventh"), numbers.round_exact(price / -1000, 3).alias("thousandth")
    )


@query("""WITH n AS (SELECT user_id % 120 AS cell, count(*) AS n FROM events WHERE user_id % 120 % 10 <> 9 GROUP BY 1),
w AS (SELECT c_custkey % 97 AS cell, n_name AS label, sum(1 + c_custkey % 7) AS weight FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2),
a AS (SELECT n.cell, n.n, label, weight, sum(weight) OVER (PARTITION BY n.cell) AS total FROM n LEFT JOIN w ON n.cell = w.cell),
p AS (SELECT *, n * weight // total AS part, n * weight % total AS rest FROM a),
d AS (SELECT cell, label, CASE WHEN weight IS NULL THEN n ELSE part + CASE WHEN row_number() OVER (PARTITION BY cell ORDER BY rest DESC, label) <= n - sum(part) OVER (PARTITION BY cell) THEN 1 ELSE 0 END END AS n FROM p)
SELECT label, CAST(sum(n) AS BIGINT) AS n, count(DISTINCT cell) AS n_cells FROM d WHERE n > 0 GROUP BY label""")
def overlay_rollup(spark, sf):
    """Events in cells of a grid, of which some are left out, rolled up to the nations whose customers lie there; each event counts once."""
    seen = b.table(spark, sf, "events").select((F.col("user_id") % 120).alias("cell_id"))
    cells = seen.distinct().withColumn("kind", F.when(F.col("cell_id") % 10 == 9, "water").otherwise("land"))
    c, n = b.table(spark, sf, "customer"), b.table(spark, sf, "nation")
    lies = c.join(n, c.c_nationkey == n.n_nationkey).select((F.col("c_custkey") % 97).alias("cell_id"), F.col("n_name").alias("label"), (1 + F.col("c_custkey") % 7).alias("weight"))
    return overlay.rollup(seen, lies, cells, F.col("kind") == "land")


# -- outbound events --

def sent_twice(spark, sf):
    """Documents as events for two targets, of which long ones are refused; then all again with their texts cut, and once more."""
    path, docs = scratch(spark), b.table(spark, sf, "documents")
    event = lambda text: F.to_json(F.struct(F.lit("signal_ready").alias("event_type"), text.alias("text")))
    rows = lambda text: docs.select(F.col("doc_id").cast("string").alias("item_id"), F.explode(F.array(F.lit("finance"), F.lit("hub"))).alias("target"), F.when(F.length(text) <= 4000, event(text)).otherwise(F.lit("cut off in {")).alias("event"))
    events.emit(rows(F.col("text")), path)  # a dry run
    for text in (F.col("text"), F.substring("text", 1, 4000), F.substring("text", 1, 4000)):
        events.emit(rows(text), path, live=True)
    return path


@query("SELECT CAST(doc_id AS VARCHAR) AS item_id, unnest(['finance', 'hub']) AS target, sha256(left(text, 4000)) AS text FROM documents")
def events_emitted(spark, sf):
    """Every event is listed once, though some were refused at first and all were sent again."""
    back = events.delivered(spark, sent_twice(spark, sf))
    return back.select("item_id", "target", F.sha2(F.get_json_object("event", "$.text"), 256).alias("text"))


@query("SELECT 2 * count(*) AS emitted, 2 * count(*) FILTER (length(text) > 4000) AS failed, 4 AS writes, 2 * count(*) AS outcomes_ok FROM documents")
def events_summary(spark, sf):
    """What all writes together delivered and had refused: nothing is delivered twice."""
    path = sent_twice(spark, sf)
    total = events.summary(spark, path)
    ok = events.outcomes(spark, path).where("error is null").count()
    return total.select("emitted", "failed", F.lit(events.commits(spark, path).count()).alias("writes"), F.lit(ok).alias("outcomes_ok"))


# -- feeds that have landed --


def landed(spark, sf):
    path = scratch(spark)
    readers.land_feeds(b.feed_pages(spark, sf), path)
    return path


@query(f"""WITH {b.FEED_ENTRIES} SELECT DISTINCT substr(sha256(source_url || '|' || strftime(published_at, '%Y-%m-%dT%H:%M:%S') || '+00:00'), 1, 16) AS item_id, source_name, source_url, regexp_replace(title, '^\\s+|\\s+$', '', 'g') AS title,
md5(body_text) AS body, published_at, 'T' || (1 + CAST(substr(source_name, 4) AS INT) % 3) AS evidence_tier FROM marked WHERE NOT cut""")
def feeds_polled(spark, sf):
    """All feeds as they landed, read by the data source; what stands on two pages counts once, and pages that are cut off leave the others."""
    items = readers.poll_all(spark, landed(spark, sf), b.FEEDS, F.timestamp_seconds(F.lit(0)))
    return items.select("item_id", "source_name", "source_url", "title", F.md5("body_text").alias("body"), "published_at", "evidence_tier")


@query(f"WITH {b.FEED_ENTRIES} SELECT source_name, count(DISTINCT page) AS failures FROM marked WHERE cut GROUP BY source_name UNION ALL SELECT 'silent', 1")
def feed_failures(spark, sf):
    """Files that can't be read, and a feed of which nothing has landed, are rows."""
    found = readers.scan_feeds(spark, landed(spark, sf), b.FEEDS).where("error is not null")
    return found.groupBy("source_name").agg(F.count(F.lit(1)).alias("failures"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
