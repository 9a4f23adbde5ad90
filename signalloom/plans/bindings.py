"""How the driver's tables stand in for items, signals and matters, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalloom.functions.lexicon import folded_term
from signalloom.functions.text import xml_text

#: Words that the driver's documents have, under the engine's labels.
DOMAINS = {
    "GEO_GEOLOGY": ["disgusting"], "ENVIRONMENTAL": ["license", "rights reserved"], "ANOMALOUS": ["avec"], "MILITARY_AEROSPACE": ["ist", "und"],
    "FINANCIAL": ["idiot", "stupid"], "POLITICAL": ["trash", "worthless"], "SAFETY_COMPLIANCE": ["con", "que"],
}
URGENT = ["worthless", "stupid", "reservéd"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as items: the first 40 characters are the title, the rest the body."""
    seconds = F.lit(1_700_000_000) + F.col("doc_id") * 60
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("item_id"), F.concat(F.lit("https://"), "source", F.lit("/"), "doc_id").alias("source_url"), F.col("source").alias("source_name"),
        F.substring("text", 1, 40).alias("title"), F.expr("substring(text, 41)").alias("body_text"), F.timestamp_seconds(seconds).alias("published_at"), F.timestamp_seconds(seconds + 3600).alias("captured_at"),
        F.lit("T2").alias("evidence_tier"), "lang",
    )


ITEMS = """items AS (SELECT CAST(doc_id AS VARCHAR) AS item_id, 'https://' || source || '/' || doc_id AS source_url, source AS source_name, substr(text, 1, 40) AS title, substr(text, 41) AS body_text,
  make_timestamp((1700000000 + doc_id * 60) * 1000000) AS published_at, make_timestamp((1700003600 + doc_id * 60) * 1000000) AS captured_at, 'T2' AS evidence_tier, lang,
  lower(strip_accents(substr(text, 1, 40) || ' ' || substr(text, 41))) AS folded FROM documents)"""


def sql_has(column: str, terms: list[str], plural: bool = True) -> str:
    """A pattern test with word borders that hold for letters beyond ASCII too."""
    any_of = "|".join(folded_term(t).replace(".", "\\.") for t in terms)
    return f"regexp_matches({column}, '(^|[^a-z0-9_ß])({any_of}){'s?' if plural else ''}([^a-z0-9_ß]|$)')"


def sql_tags(column: str, lexicon: dict[str, list[str]], plural: bool = True) -> str:
    each = ", ".join(f"CASE WHEN {sql_has(column, terms, plural)} THEN '{label}' END" for label, terms in lexicon.items())
    return f"list_filter([{each}], lambda x: x IS NOT NULL)"


TAGGED = f"tagged AS (SELECT *, {sql_tags('folded', DOMAINS)} AS kw FROM items)"
CLASSIFIED = """classified AS (SELECT *, CASE WHEN len(kw) > 0 THEN kw ELSE ['UNCLASSIFIED'] END AS labels, CASE WHEN len(kw) >= 2 THEN 0.85 WHEN len(kw) = 1 THEN 0.6 ELSE 0.3 END::DOUBLE AS confidence FROM tagged)"""
BASE = f"WITH {ITEMS}, {TAGGED}, {CLASSIFIED}"


def sql_targets(of: dict[str, str], hub: str) -> str:
    """Distinct targets in label order, the hub last."""
    case = " ".join(f"WHEN '{k}' THEN '{t}'" for k, t in of.items())
    mapped = f"list_filter(list_transform(labels, lambda x: CASE x {case} END), lambda t: t IS NOT NULL)"
    return f"list_append(list_filter({mapped}, lambda t, i: list_position({mapped}, t) = i), '{hub}')"


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as signals: line is the order key, the customer the matter, the customer's nation a municipality, the priority an agency."""
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    rows = o.join(c, o.o_custkey == c.c_custkey, "left").join(n, F.col("c_nationkey") == n.n_nationkey, "left")
    none = F.array().cast("array<string>")
    return rows.select(
        F.col("o_orderkey").alias("line"), F.concat(F.lit("SIG-"), F.floor(F.col("o_orderkey") / 2).cast("string")).alias("signal_id"), F.concat(F.lit("MAT-"), "o_custkey").alias("matter_id"),
        F.concat(F.lower("o_orderstatus"), F.lit("_signal")).alias("signal_type"), F.col("c_name").alias("title"), F.lit("").alias("summary"), F.concat(F.lit("SRC-"), F.col("o_custkey") % 40).alias("source_id"),
        F.lit(None).cast("string").alias("source_url"), F.col("o_orderdate").alias("captured_at"), F.lit("raw_observation").alias("signal_stage"), F.lower("c_mktsegment").alias("beat"),
        F.when(F.col("n_name").isNotNull(), F.array("n_name")).otherwise(none).alias("municipalities"), F.array(F.expr("substring(o_orderpriority, 3)")).alias("agencies"),
        F.round(F.col("o_totalprice") % 100, 0).alias("confidence_score"), F.lit("T2").alias("evidence_tier"), F.lit("raw").alias("handoff_status"), F.lit(None).cast("string").alias("deadline_date"), F.lit(False).alias("is_synthetic"),
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as sources; some have ids that no signal names, and families are missing or empty for some."""
    s = table(spark, sf_dir, "supplier")
    unheard = F.when(F.col("s_suppkey") % 4 == 3, "none-").otherwise("")
    return s.select(F.concat(F.lit("SRC-"), unheard, "s_suppkey").alias("source_id"), F.col("s_name").alias("name"), F.when(F.col("s_suppkey") % 3 == 0, "").when(F.col("s_suppkey") % 3 == 1, "family").alias("source_family"))


def sql_fid(prefix: str, *parts: str) -> str:
    inside = " || '|' || ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts)
    return f"'{prefix}_' || substr(sha256({inside}), 1, 32)"


def sql_norm(x: str) -> str:
    return f"trim(regexp_replace(lower(strip_accents({x})), '[^a-z0-9]+', ' ', 'g'))"


SIGNALS = f"""sig AS (SELECT o_orderkey AS line, 'SIG-' || (o_orderkey // 2) AS signal_id, 'MAT-' || o_custkey AS matter_id, lower(o_orderstatus) || '_signal' AS signal_type, c_name AS title,
  'SRC-' || (o_custkey % 40) AS source_id, o_orderdate AS captured_at, lower(c_mktsegment) AS beat, n_name AS municipality, substr(o_orderpriority, 3) AS agency, CAST(printf('%.3f', CAST(round(o_totalprice % 100, 0) AS DOUBLE) / 100) AS DOUBLE) AS confidence
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey),
reg AS (SELECT 'SRC-' || CASE WHEN s_suppkey % 4 = 3 THEN 'none-' ELSE '' END || s_suppkey AS ref, s_name AS name, CASE WHEN s_suppkey % 3 = 0 THEN '' WHEN s_suppkey % 3 = 1 THEN 'family' END AS family FROM supplier),
ids AS (SELECT *, {sql_fid('src', 'source_id')} AS src, {sql_fid('ent', "'matter'", 'matter_id')} AS ent FROM sig)"""


#: Documents of one feed whose ids fall into the same range are on a page.
FEED_PAGE = 512
FEEDS = [{"name": f"src{i}", "url": f"https://src{i}/feed", "tier": f"T{1 + i % 3}"} for i in range(20)] + [{"name": "silent", "url": "https://silent/feed"}]


def feed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pages of their sources' feeds: url, page, xml. Entries of ids divisible by 10 stand on the next page too; second pages of three of sources ending in 7 are cut off."""
    docs = items(spark, sf_dir).withColumn("id", F.col("item_id").cast("long"))
    pages = F.filter(F.array(F.floor(F.col("id") / FEED_PAGE), F.when(F.col("id") % 10 == 0, F.floor(F.col("id") / FEED_PAGE) + 1)), lambda x: x.isNotNull())
    when = F.concat(F.date_format("published_at", "dd MMM yyyy HH:mm:ss"), F.lit(" +0000"))
    tag = lambda name, value: F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))
    entry = tag("item", F.concat(tag("title", xml_text(F.coalesce("title", F.lit("")))), tag("link", xml_text(F.col("source_url"))), tag("description", xml_text(F.coalesce("body_text", F.lit("")))), tag("pubDate", when)))
    rows = docs.select("source_name", F.explode(pages).alias("page"), "id", entry.alias("entry")).groupBy("source_name", "page")
    pages = rows.agg(tag("rss", tag("channel", F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "entry"))), lambda x: x["entry"]), ""))).alias("xml"))
    cut = F.endswith("source_name", F.lit("7")) & (F.col("page") % 3 == 1)
    return pages.select(F.concat(F.lit("https://"), "source_name", F.lit("/feed")).alias("url"), "page", F.when(cut, F.substring("xml", F.lit(1), F.length("xml") - 9)).otherwise(F.col("xml")).alias("xml"))


FEED_ENTRIES = f"""{ITEMS}, paged AS (SELECT *, unnest(CASE WHEN CAST(item_id AS BIGINT) % 10 = 0 THEN [CAST(item_id AS BIGINT) // {FEED_PAGE}, CAST(item_id AS BIGINT) // {FEED_PAGE} + 1] ELSE [CAST(item_id AS BIGINT) // {FEED_PAGE}] END) AS page FROM items),
marked AS (SELECT *, source_name LIKE '%7' AND page % 3 = 1 AS cut FROM paged)"""


#: What a payload of an order must look like; the tables break each of its rules somewhere.
ORDER_SCHEMA = {
    "type": "object", "required": ["order", "placed", "customer", "lines"], "additionalProperties": False,
    "properties": {
        "order": {"type": "integer", "minimum": 0}, "placed": {"type": "string", "format": "date-time"}, "priority": {"enum": ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]},
        "customer": {"type": "object", "required": ["id", "segment"], "properties": {"id": {"type": "integer"}, "segment": {"type": ["string", "null"], "pattern": "^[A-Z]{1,9}$"}}},
        "lines": {"type": "array", "minItems": 2, "items": {"$ref": "#/$defs/line"}},
    },
    "$defs": {"line": {"type": "object", "required": ["shipped"], "properties": {"quantity": {"type": "number", "maximum": 45}, "flag": {"type": "string", "enum": ["A", "R"]}, "discount": {"type": "number", "minimum": 0.01}, "shipped": {"type": "string", "format": "date"}}}},
}


def order_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their lines and customers as JSON: o_orderkey, payload."""
    o, c, li = (table(spark, sf_dir, t) for t in ("orders", "customer", "lineitem"))
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").alias("quantity"), F.col("l_returnflag").alias("flag"), F.col("l_discount").alias("discount"), F.when(F.col("l_partkey") % 10 > 0, F.date_format("l_shipdate", "yyyy-MM-dd")).alias("shipped"))
    lines = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    rows = o.join(c, o.o_custkey == c.c_custkey, "left").join(lines, o.o_orderkey == lines.l_orderkey, "left")
    key = F.col("o_orderkey")
    placed = F.when(key % 7 > 0, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    who = F.struct(F.col("o_custkey").alias("id"), F.when(key % 5 > 0, F.col("c_mktsegment")).alias("segment"))
    payload = F.to_json(F.struct(key.alias("order"), placed.alias("placed"), F.col("o_orderpriority").alias("priority"), who.alias("customer"), F.col("lines"), F.when(key % 13 == 0, 1).alias("extra")))
    return rows.select("o_orderkey", payload.alias("payload"))


ORDER_FINDINGS = """WITH n AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_discount, l_shipdate) - 1 AS pos, count(*) OVER (PARTITION BY l_orderkey) AS lines FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)),
o AS (SELECT o_orderkey, o_orderpriority, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey)
SELECT o_orderkey, '$.placed' AS path, 'format' AS rule FROM o WHERE o_orderkey % 7 = 0 UNION ALL SELECT o_orderkey, '$.priority', 'enum' FROM o WHERE o_orderpriority = '4-NOT SPECIFIED' UNION ALL SELECT o_orderkey, '$.extra', 'additionalProperties' FROM o WHERE o_orderkey % 13 = 0
UNION ALL SELECT o_orderkey, '$.customer.segment', 'required' FROM o WHERE o_orderkey % 5 = 0 OR c_mktsegment IS NULL UNION ALL SELECT o_orderkey, '$.customer.segment', 'pattern' FROM o WHERE o_orderkey % 5 > 0 AND length(c_mktsegment) > 9
UNION ALL SELECT o_orderkey, '$.lines', 'required' FROM o WHERE o_orderkey NOT IN (SELECT l_orderkey FROM n) UNION ALL SELECT l_orderkey, '$.lines', 'minItems' FROM n WHERE lines = 1
UNION ALL SELECT l_orderkey, '$.lines[' || pos || '].quantity', 'maximum' FROM n WHERE l_quantity > 45 UNION ALL SELECT l_orderkey, '$.lines[' || pos || '].flag', 'enum' FROM n WHERE l_returnflag NOT IN ('A', 'R')
UNION ALL SELECT l_orderkey, '$.lines[' || pos || '].discount', 'minimum' FROM n WHERE l_discount < 0.01 UNION ALL SELECT l_orderkey, '$.lines[' || pos || '].shipped', 'required' FROM n WHERE l_partkey % 10 = 0"""


def length_scorer():
    """A scorer that goes by the length of a body, and can't take some: their number of characters ends in 7."""

    def answers(titles: list[str], bodies: list[str]) -> list:
        if any(len(x) % 10 == 7 for x in bodies):
            raise ValueError("a length that ends in 7")
        kinds = (["FINANCIAL", "NO_SUCH_LABEL"], ["NO_SUCH_LABEL"], ["POLITICAL", "SAFETY_COMPLIANCE"])
        return ["no JSON" if len(x) % 10 == 3 else {"labels": kinds[len(x) % 3], "confidence": None if len(x) % 10 == 0 else len(x) % 100 / 100} for x in bodies]

    return answers
