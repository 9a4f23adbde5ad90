import json

import pytest
from pyspark.sql import functions as F

from signalloom.functions import extract
from signalloom.operators import classify, dedup, entities, ledger, lifecycle, lookup, quality, routing, search, views
from signalloom.sources import readers, sinks
from signalloom.streaming import ingest


def now():
    return F.lit("2026-01-01 00:00:00").cast("timestamp")


@pytest.fixture(scope="module")
def items(spark):
    rows = [
        ("a", "Flood warning", "the flood reached the reservoir and the war zone", "Src"),
        ("b", "Contract awarded", "contract awarded to Norte Build for $5 million", "Src"),
        ("c", "Nothing here", "a quiet day", "Src"),
    ]
    df = spark.createDataFrame(rows, "item_id string, title string, body_text string, source_name string")
    ts = F.lit("2026-01-01 10:00:00").cast("timestamp")
    return df.select("*", F.concat(F.lit("http://x/"), "item_id").alias("source_url"), ts.alias("published_at"), ts.alias("captured_at"), F.lit("T1").alias("evidence_tier"))


def by(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_tiers(spark, items):
    plain = classify.classify(items)
    assert by(plain, "item_id", "labels") == {"a": ["ENVIRONMENTAL", "POLITICAL"], "b": ["FINANCIAL"], "c": ["UNCLASSIFIED"]}
    assert by(plain, "item_id", "confidence") == {"a": 0.85, "b": 0.6, "c": 0.3}
    guess = spark.createDataFrame([("b", ["POLITICAL", "NOPE"], 0.9, "why"), ("c", ["NOPE"], None, None), ("a", ["ANOMALOUS"], 1.0, "x")], "item_id string, model_labels array<string>, model_confidence double, model_reasoning string")
    model = classify.classify(items, predictions=guess)
    assert by(model, "item_id", "labels") == {"a": ["ENVIRONMENTAL", "POLITICAL"], "b": ["POLITICAL", "FINANCIAL"], "c": ["UNCLASSIFIED"]}
    assert by(model, "item_id", "confidence") == {"a": 0.85, "b": 0.9, "c": 0.5}


def test_routing(spark, items, tmp_path):
    rows = classify.with_flags(classify.enrich(classify.classify(items)))
    routed = routing.fan_out(rows)
    assert sorted((r.item_id, r.target) for r in routed.collect()) == [("a", "finance"), ("a", "hub"), ("a", "water"), ("b", "finance"), ("b", "hub")]
    made = {(r.item_id, r.target): json.loads(r.payload) for r in routing.payloads(routed, now()).collect()}
    assert made["b", "finance"]["recipients"] == ["Norte Build"] and made["b", "finance"]["estimated_value"] == 5e6
    assert "recipients" not in made["b", "hub"] and made["a", "water"]["domain_tags"] == ["reservoir_drought", "flood"] and "domain_tags" not in made["a", "finance"]
    errors = spark.createDataFrame([("a", "water", "disk full")], "item_id string, target string, error string")
    records = routing.dispatch_records(rows, now(), errors)
    assert {r.item_id: (r.status, r.dispatched_to) for r in records.collect()} == {"a": ("failed", ["finance", "hub"]), "b": ("ok", ["finance", "hub"]), "c": ("skipped", [])}
    path = str(tmp_path / "out")
    sinks.write_payloads(routing.payloads(routed, now()), path, dry_run=True)
    assert not (tmp_path / "out").exists()
    sinks.write_payloads(routing.payloads(routed, now()), path)
    assert readers.outbound(spark, path, "water").count() == 1 and readers.outbound(spark, path, item="b").count() == 2
    back = {(r.item_id, r.target): json.loads(r.payload) for r in readers.outbound(spark, path).collect()}
    assert back == made and list(back) == sorted(back, key=lambda k: (k[1], k[0]))
    assert routing.run_summary(items, records).first().asDict() == {"ingested": 3, "dispatched": 1, "gated": 1, "breakdown": {"failed": 1, "ok": 1, "skipped": 1}}
    again = records.unionByName(records.where("item_id = 'a'").withColumns({"status": F.lit("ok"), "dispatched_at": now() + F.expr("interval 1 day")}))
    assert by(routing.dispatch_state(items, again), "item_id", "dispatch_status") == {"a": "ok", "b": "ok", "c": "skipped"} and routing.dispatch_state(items, again).count() == 3
    sinks.write_dispatches(records, str(tmp_path / "d"), "1")
    assert sinks.write_dispatches(records.where("item_id = 'a'").withColumn("status", F.lit("ok")), str(tmp_path / "d"), "2").where("status = 'ok'").count() == 2
    sent = spark.createDataFrame([("a", None), ("b", "refused")], "item_id string, error string")
    assert routing.emit_summary(sent).first().asDict() == {"emitted": 1, "failed": 1}
    assert [r.target for r in views.sorted_targets(routed).collect()] == ["finance", "hub", "water"]
    assert views.item_detail(items, records, "c").first().dispatch_status == "skipped"
    with pytest.raises(KeyError):
        views.item_detail(items, records, "nothing")


def test_events_are_bounded(spark):
    bodies = {"i": ("é" * 200_000, "v" * 30_000), "j": ("x", "v" * 70_000), "k": (None, "v"), "l": ("🙂" * 6000, ""), "m": ("b" * 9000, "")}
    rows = spark.createDataFrame([(i, "t", b) for i, b in bodies.items()], "item_id string, target string, signal struct<body_text:string,k:string>")
    made = routing.bounded_events(rows, "e").collect()
    got = {r.item_id: json.loads(r.event)["client_payload"] for r in made}
    for r in made:
        plain = json.dumps(got[r.item_id], separators=(",", ":"))
        assert r.event_chars == len(plain) and (r.event_chars <= 60_000 or got[r.item_id]["signal"]["body_text"] == "")
    halves = [8000 + 13]
    while halves[-1] // 2 >= 100:
        halves.append(halves[-1] // 2 + 13)
    assert len(got["i"]["signal"]["body_text"]) == halves[1] and got["i"]["signal"]["body_text"].endswith("[truncated]")
    assert got["j"]["signal"]["body_text"] == "" and got["k"]["signal"]["body_text"] is None and len(got["l"]["signal"]["body_text"]) == 3013 and len(got["m"]["signal"]["body_text"]) == 8013


def test_lengths_of_events(spark):
    """A payload is written out once for its length and once to be sent, not again for each body that is tried."""
    rows = spark.createDataFrame([("a", "t", ("é🙂" * 5000, "é" * 9_990)), ("b", "t", ('\n"\\' * 9000, "🙂a" * 2000)), ("c", "t", None)], "item_id string, target string, signal struct<body_text:string,k:string>")
    made = routing.bounded_events(rows, "e")
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("repo, target#") == 2
    for r in made.collect():
        assert r.event_chars == len(json.dumps(json.loads(r.event)["client_payload"], separators=(",", ":"))) <= 60_000


def test_dedup_and_patches(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "k int, v string")
    assert sorted(map(str, dedup.upsert(old, new, ["k"]).collect())) == sorted(map(str, [(1, "a"), (2, "B"), (3, "C"), (None, "N")])) or by(dedup.upsert(old, new, ["k"]), "k", "v") == {1: "a", 2: "B", 3: "C", None: "N"}
    assert by(dedup.insert_absent(old, new, ["k"]), "k", "v") == {1: "a", 2: "b", 3: "C", None: "n"}
    assert by(dedup.patch(old, new.where("k is not null"), "k"), "k", "v") == {1: "a", 2: "B", None: "n"}
    rows = spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], "k int, at int, v string")
    assert by(dedup.first_wins(rows, ["k"], F.col("at")), "k", "v") == {1: "x"} and by(dedup.last_wins(rows, ["k"], "at"), "k", "v") == {1: "y"}
    blank = spark.createDataFrame([(2, None, "w")], "k int, v string, w string")
    assert by(dedup.patch(old, blank, "k", nulls=True), "k", "v") == {1: "a", 2: None, None: "n"} and by(dedup.patch(old, blank, "k"), "k", "w") == {1: None, 2: "w", None: None}
    assert by(dedup.delete(old, new.select("k"), "k"), "k", "v") == {1: "a", None: "n"}
    made = dedup.stamped(rows, now(), is_new=True).collect()
    assert len({r.id for r in made}) == 2 and all(r.created_date == r.updated_date for r in made)
    assert "created_date" not in dedup.stamped(rows, now()).columns


def test_places(spark):
    features = spark.createDataFrame([("1", "Río Uno", "rio uno", "river", "hydro"), ("2", "Monte", "cerro", "peak", "terrain"), ("3", "CERRO", "", "peak", "terrain")], "canonical_id string, canonical_name string, normalized_name string, feature_type string, `group` string")
    places = spark.createDataFrame([("RIO--uno",), ("Cerro",), ("nowhere",), (None,)], "place string")
    got = lookup.resolve_places(places, features, "place").collect()
    assert {r.place: (r.resolution_status, r.canonical_id, r.candidate_count) for r in got} == {"RIO--uno": ("resolved", "1", None), "Cerro": ("collision_review_required", None, 2), "nowhere": ("unresolved", None, None), None: ("unresolved", None, None)}


def test_search(spark):
    df = spark.createDataFrame([("A", 1, None), ("b", None, "a!"), ("c", 3, "x")], "n string, s int, t string")
    assert search.text_search(df, " a ", ["n", "t"]).count() == 2 and search.text_search(df, None, ["n"]).count() == 3
    assert [r.n for r in search.page(df, "-s", "n").collect()] == ["c", "A", "b"] and [r.n for r in search.page(df, "s", "n", 1).collect()] == ["b"]
    assert search.criteria(df, {"t": None}).count() == 1 and search.criteria(df, {"n": ["A", "c"], "s": 3}).count() == 1 and search.criteria(df, {}).count() == 3
    with pytest.raises(ValueError):
        search.latest_items(df, limit=0)


def test_streams_of_a_package_are_worked_out_once(spark, tmp_path):
    """Rows that differ each time they are worked out: the manifest says what stands in the files."""
    path, made = str(tmp_path / "p"), spark.range(500).withColumns({"x": F.randstr(F.lit(8)), "synthetic": F.lit(False)})
    said = sinks.write_package({"a": made, "none": made.limit(0)}, path, "production", "now", "me")
    n, digest, _ = sinks.digest_of(spark.read.text(f"{path}/a"))
    assert [(f["record_count"], f["digest"]) for f in said["files"]] == [(n, digest)] == [(500, digest)]
    with pytest.raises(ValueError):  # what is refused leaves an earlier package as it was
        sinks.write_package({"a": made.withColumn("synthetic", F.col("id") == 7)}, path, "production", "now", "me")
    assert sinks.digest_of(spark.read.text(f"{path}/a"))[:2] == (n, digest) and sinks.read_manifest(spark, path) == said
    assert sorted(p.name for p in (tmp_path / "p").iterdir()) == ["a", "manifest"]


@pytest.fixture(scope="module")
def signals(spark, items):
    rows = ledger.to_signals(classify.classify(items))
    return rows.withColumns({"line": F.monotonically_increasing_id(), "agencies": F.array(F.lit("Fema"), F.lit("FEMA")), "municipalities": F.array(F.lit("Añasco"))})


def test_ledger_and_streams(spark, signals, tmp_path):
    back = ledger.to_items(signals)
    assert sorted(r.item_id for r in back.collect()) == ["a", "b", "c"] and by(back, "item_id", "confidence")["a"] == 0.85
    registry = spark.createDataFrame([("SRC-RSS-SRC", "The source", "")], "source_id string, name string, source_family string")
    parts = ledger.streams(signals, registry, now())
    assert {k: df.count() for k, df in parts.items()} == {"sources": 1, "entities": 5, "relationships": 6, "observations": 3}
    assert parts["sources"].first().source_name == "The source" and parts["sources"].first().source_type == "unknown"
    ends = parts["relationships"].select(F.col("target_entity_id").alias("entity_id")).union(parts["relationships"].select("source_entity_id"))
    assert lookup.missing_references(ends, parts["entities"], "entity_id").isEmpty()
    one, two = (sinks.write_package(p, str(tmp_path / n), "production", "now", "me") for n, p in (("a", parts), ("b", {k: df.repartition(3) for k, df in parts.items()})))
    assert one["package_id"] == two["package_id"] and len(one["files"]) == 4
    assert sinks.read_manifest(spark, str(tmp_path / "a")) == one and sinks.stream_counts(one) == {"sources": 1, "entities": 5, "relationships": 6, "observations": 3}
    assert sinks.write_package({k: df.limit(2) for k, df in parts.items()}, str(tmp_path / "e"), "production", "now", "me")["package_id"] != one["package_id"]
    with pytest.raises(ValueError):
        sinks.write_package(ledger.streams(signals.withColumn("is_synthetic", F.lit(True)), registry, now()), str(tmp_path / "c"), "production", "now", "me")
    path = str(tmp_path / "ledger")
    sinks.write_ledger(signals.drop("line"), path)
    assert readers.ledger(spark, path).count() == 3
    with pytest.raises(ValueError):
        sinks.write_ledger(signals.limit(0), path)
    both = readers.ledgers(spark, [path, str(tmp_path / "none"), path])
    assert both.count() == 6 and both.select("line").distinct().count() == 6
    (tmp_path / "reg.csv").write_text("source_id,name\n")
    out = sinks.export(spark, [path], str(tmp_path / "reg.csv"), str(tmp_path / "x"), "2026-01-01 00:00:00", "me", "production")
    assert out["mode"] == "production" and sinks.stream_counts(out)["observations"] == 3
    with pytest.raises(ValueError):
        sinks.export(spark, [path], str(tmp_path / "reg.csv"), str(tmp_path / "y"), "2026-01-01 00:00:00", "me", "other")


def test_lines_follow_files(spark, tmp_path):
    (tmp_path / "t").mkdir()
    for name in ("b", "a"):
        (tmp_path / "t" / f"{name}.txt").write_text("".join(f"{name}{i:05d}\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        got = readers.ledger_lines(spark, str(tmp_path / "t")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.value for r in sorted(got, key=lambda r: r.line)] == [f"{n}{i:05d}" for n in "ab" for i in range(3000)] and sorted(r.line for r in got) == list(range(6000))


def test_stores(spark, tmp_path):
    seed = {"matters": spark.createDataFrame([(1, "seed")], "k int, v string"), "signals": spark.createDataFrame([(1,)], "k int")}
    path = str(tmp_path / "store")
    assert by(sinks.read_store(spark, path, seed)["matters"], "k", "v") == {1: "seed"}
    sinks.write_store({"matters": spark.createDataFrame([(1, "new")], "k int, v string")}, path, "1")
    found = sinks.read_store(spark, path, seed)
    assert by(found["matters"], "k", "v") == {1: "new"} and found["signals"].count() == 1
    sinks.reset_store(spark, path)
    assert by(sinks.read_store(spark, path, seed)["matters"], "k", "v") == {1: "seed"}
    assert views.or_default(seed["signals"].limit(0), seed["signals"]).count() == 1
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.json").write_text("{}")
    assert by(readers.directory_counts(spark, queue=str(tmp_path / "f"), classified=str(tmp_path / "no")), "stage", "n") == {"queue": 1, "classified": 0}


def test_views(spark):
    signals = spark.createDataFrame([("s1", "m1", "src", "ready", 90.0, "2026-01-02"), ("s2", "m1", "src", "raw", None, "2026-01-03"), ("s3", "m2", "x", "ready", 85.0, None)], "signal_id string, matter_id string, source_id string, handoff_status string, confidence_score double, captured_at string")
    matters = spark.createDataFrame([("m1", "one", 10.0), ("m2", "two", None), ("m3", "m1", 50.0)], "matter_id string, id string, confidence_score double")
    records = spark.createDataFrame([("r1", "m1"), ("r2", "one")], "record_id string, matter_id string")
    sources = spark.createDataFrame([("a", "n", "broken"), ("b", "m", "fine"), ("c", "k", None)], "source_id string, name string, status string")
    store = {"signals": signals, "matters": matters, "records": records, "sources": sources, "candidates": spark.createDataFrame([("c1",)], "candidate_id string")}
    assert views.monitor(store).first().asDict() == {"signals": 3, "matters": 3, "ready": 3, "high_confidence": 2, "stale_sources": 1}
    pages = views.first_pages(store)
    assert [r.signal_id for r in pages["signals"].collect()] == ["s2", "s1", "s3"] and [r.source_id for r in pages["sources"].collect()] == ["c", "b", "a"] and pages["records"].count() == 2
    assert [r.signal_id for r in views.top_signals(signals, 1).collect()] == ["s2"]
    assert [r.matter_id for r in views.by_confidence(matters).collect()] == ["m3", "m1", "m2"]
    detail = views.matter_detail(store, "one")
    assert detail["matters"].first().matter_id == "m1" and detail["signals"].count() == 2 and detail["records"].count() == 2
    assert {r.matter_id: (r.n_signals, r.n_sources, r.n_records) for r in views.matter_counts(store).collect()} == {"m1": (2, 1, 1), "m2": (1, 1, 0), "m3": (0, 0, 0)}
    with pytest.raises(KeyError):
        views.matter_detail(store, "nothing")
    row = spark.range(1).select(views.whole_percent(F.lit(0.845)).alias("p"), views.short_id(F.lit("abcdefghijklmno")).alias("i"), views.display_date(F.lit("2026-03-04").cast("date")).alias("d"), views.display_date(F.lit(None).cast("date")).alias("n")).first()
    assert tuple(row) == (85, "abcdefghijkl", "4 Mar 2026", "")


def test_schemas(spark):
    schema = {"required": ["a", "b", "z"], "properties": {"a": {"enum": ["x", "y"]}, "b": {"minimum": 0, "maximum": 1}, "c": {"minLength": 2, "pattern": "^q"}, "d": {"minItems": 1}}}
    rows = spark.createDataFrame([("x", 0.5, None, [1]), ("n", 2.0, "p", []), (None, None, "qq", None)], "a string, b double, c string, d array<int>")
    assert [r.f for r in rows.select(quality.schema_faults(rows, schema).alias("f")).collect()] == [["z"], ["a", "b", "z", "c", "d"], ["a", "b", "z"]]
    assert quality.required_fields('{"required": ["a", 1, "b"]}') == ["a", "b"] and quality.required_fields("{") == [] and quality.required_fields(None) == []
    sums = spark.createDataFrame([(5, 2, {"x": 1, "y": 2}, 3), (5, 2, {"x": 1}, 2)], "total long, automated long, queued map<string,long>, queued_total long")
    assert [r.f for r in sums.select(quality.coverage_faults(*(F.col(c) for c in sums.columns)).alias("f")).collect()] == [[], ["total", "queued"]]


def test_entities(spark):
    s = spark.createDataFrame([(1, "s1", ["Fema", ""], ["José P."]), (2, "s2", None, ["jose p", "Fema "])], "line long, signal_id string, agencies array<string>, entities array<string>")
    m = spark.createDataFrame([(1, ["JOSÉ-P"], ["Ana"], ["??"])], "line long, agencies array<string>, people array<string>, organizations array<string>")
    mentioned = entities.mentions(s, m)
    got = {r.slug: (r.name, r.type, r.mention_count, r.n_signals) for r in entities.profiles(mentioned).collect()}
    assert got == {"fema": ("Fema", "agency", 2, 2), "jose-p": ("José P.", "agency", 3, 2), "ana": ("Ana", "person", 1, 0)}
    assert [r.signal_id for r in entities.signals_of(s, mentioned, "jose-p").orderBy("line").collect()] == ["s1", "s2"] and entities.signals_of(s, mentioned, "ana").isEmpty()
    assert views.entity_detail(s, entities.profiles(mentioned), mentioned, "fema")["signals"].count() == 2


def test_lifecycle(spark):
    from signalloom.plans import registry

    sf = "/root/testdata/sf0.001"
    store = registry.store(spark, sf)
    chosen = store["candidates"].select("candidate_id").limit(5)
    chosen = spark.createDataFrame(chosen.collect(), "candidate_id string")
    done = lifecycle.accept(store, chosen, now())
    assert done["candidates"].where("status in ('accepted_created_record', 'linked_existing_record')").count() == 5
    assert done["matters"].where("sync_status = 'synced_local' and status_lifecycle = 'officialized'").count() == 5
    again = lifecycle.accept(done, chosen, now())
    assert again["records"].count() == done["records"].count()
    no = spark.createDataFrame([(chosen.first().candidate_id, None)], "candidate_id string, reviewer_note string")
    assert lifecycle.reject(store, no)["candidates"].where("status = 'rejected'").count() == 1
    with pytest.raises(KeyError):
        lifecycle.reject(store, spark.createDataFrame([("none", "x")], "candidate_id string, reviewer_note string"))
    assert lifecycle.invoke("unheard_of", store) is store


def test_two_candidates_of_a_matter_and_records_that_are_there(spark):
    none = F.array().cast("array<string>")
    matters = spark.createDataFrame([("m1", "T1", "contract", "", "public_signal"), ("m2", "T2", "contract", "id2", "public_signal")], "matter_id string, title string, matter_type string, official_identifier string, status_lifecycle string")
    matters = matters.withColumns({"handoff_triggers": none, "official_source_url": F.lit(""), "confidence_score": F.lit(1.0), "amount_confirmed": F.lit(None).cast("double"), "agencies": none, "organizations": none, "record_ids": none, "sync_status": F.lit("")})
    signals = spark.createDataFrame([("s1", "m1", "raw"), ("s2", "m2", "raw")], "signal_id string, matter_id string, handoff_status string").withColumn("handoff_triggers", none)
    candidates = spark.createDataFrame([("c1", "m1", ""), ("c2", "m1", ""), ("c3", "m1", "permit_record"), ("c4", "m2", "")], "candidate_id string, matter_id string, target_record_type string")
    candidates = candidates.withColumns({"title": F.lit("t"), "status": F.lit("ready_for_review"), "record_id": F.lit(None).cast("string"), "reviewer_note": F.lit(None).cast("string")})
    records = spark.createDataFrame([("r2", "m2", "contract_record", "id2", "old key", "2025-05-05", ["s0"], 7.0)], "record_id string, matter_id string, record_type string, official_identifier string, canonical_key string, effective_date string, linked_signal_ids array<string>, amount_confirmed double")
    store = {"matters": matters, "signals": signals, "candidates": candidates, "records": records}
    done = lifecycle.accept(store, candidates.select("candidate_id"), now())
    got = {r.candidate_id: (r.status, r.record_id) for r in done["candidates"].collect()}
    assert done["candidates"].count() == 4 and got["c1"][0] == "accepted_created_record" and got["c2"] == ("linked_existing_record", got["c1"][1])
    assert got["c3"][0] == "accepted_created_record" and got["c3"][1] != got["c1"][1] and got["c4"] == ("linked_existing_record", "r2")
    made = {r.record_id: r for r in done["records"].collect()}
    assert len(made) == 3 and made["r2"].effective_date == "2025-05-05" and made["r2"].linked_signal_ids == ["s0", "s2"] and made["r2"].amount_confirmed is None and made["r2"].sync_status == "linked_existing"
    assert sorted(by(done["matters"], "matter_id", "record_ids")["m1"]) == sorted({got["c1"][1], got["c3"][1]})
    new = spark.createDataFrame([("m2", "contract_record", "id2", "", "T2", None, 9.0), ("m1", "law_record", "law9", "", "L", ["s9"], None)], "matter_id string, record_type string, official_identifier string, official_source_url string, title string, linked_signal_ids array<string>, amount_confirmed double")
    synced = {r.record_id: r for r in lifecycle.sync(store, new, now())["records"].collect()}
    assert len(synced) == 2 and synced["r2"].effective_date == "2025-05-05" and synced["r2"].linked_signal_ids == ["s0"] and synced["r2"].amount_confirmed == 9.0 and synced["r2"].sync_status == "updated_from_sync"
    (other,) = [r for k, r in synced.items() if k != "r2"]
    assert other.sync_status == "created_from_sync" and other.linked_signal_ids == ["s9"] and other.record_id.startswith("record-m1-")


def test_guard(spark):
    df = spark.createDataFrame([("Contrato ADJUDICADO", "public_signal"), ("auditoria final", "officialized"), ("anunciado", "x"), (None, None)], "t string, s string")
    got = [tuple(r.g) for r in df.select(lifecycle.language_guard(F.col("t"), F.col("s")).alias("g")).collect()]
    assert got == [("blocked_official_claim", ["contrato adjudicado"]), ("needs_review", ["auditoría final"]), ("clean", []), ("clean", [])]


def test_quality(spark):
    lines = spark.createDataFrame([(0, '{"signal_id": "s", "title": "t"}'), (1, "{oops"), (2, " "), (3, "[1]"), (4, '{"signal_id": "z"}'), (5, '{"title": null}')], "line long, value string")
    found = quality.ledger_findings(lines, ["signal_id", "title"], "live")
    assert sorted((r.finding_id, r.line) for r in found.collect()) == [("schema:live_line_1", 2), ("schema:live_line_3", 4), ("schema:live_missing_5", 6), ("schema:live_missing_z", 5)]
    assert quality.report(found).first().asDict() == {"findings": 4, "critical": 4, "promotion_blocked": True}
    targets, contracts = spark.createDataFrame([("a",), ("b",), ("c",)], "target string"), spark.createDataFrame([("a", "{}"), ("b", "{")], "target string, schema string")
    assert by(quality.contract_findings(targets, contracts), "target", "message") == {"b": "contract is not valid JSON", "c": "contract missing"}
    cells = spark.range(6).select(F.col("id").alias("cell_id"), F.floor(F.col("id") / 3).alias("row_index"), (F.col("id") % 3).alias("column_index"), F.lit("LAND").alias("classification"))
    assert quality.grid_coverage(cells, 2, 3, ["LAND"]).first().is_whole and not quality.grid_coverage(cells, 2, 4, ["LAND"]).first().is_whole
    assert quality.run_checks(spark, {"x": lambda: found, "y": lambda: found}, ["x"]).count() == 4
    assert quality.same_sets(targets, targets.union(targets)) and not quality.same_sets(targets, targets.limit(1))


def test_sources(spark, tmp_path):
    good = {"item_id": "a", "source_url": "u", "published_at": "2026-01-01T00:00:00Z"}
    (tmp_path / "q").mkdir()
    (tmp_path / "q" / "1.json").write_text(json.dumps(good, indent=1))
    (tmp_path / "q" / "2.json").write_text("{bad")
    assert readers.json_files(spark, str(tmp_path / "q"), readers.RAW_ITEM, strict=False).count() == 1
    assert readers.json_files(spark, str(tmp_path / "none"), readers.RAW_ITEM, strict=False).count() == 0
    with pytest.raises(Exception):
        readers.json_files(spark, str(tmp_path / "q"), readers.RAW_ITEM).collect()
    (tmp_path / "reg.csv").write_text("source_id,name,language,source_family,reliability_default,scrape_method,active,notes\ns1,Old,,,,,,\ns1,New,,,,,,\n")
    assert [r.name for r in readers.source_registry(spark, str(tmp_path / "reg.csv")).collect()] == ["New"]
    assert readers.source_registry(spark, str(tmp_path / "no.csv")).count() == 0
    entries = spark.createDataFrame(
        [(0, 0, "S", None, "http://a", " T\n", "", "body", "Tue, 06 Jan 2026 10:00:00 +0000", None), (0, 1, "S", "T1", "http://a", "again", "", "", "Tue, 06 Jan 2026 10:00:00 +0000", None), (0, 2, "S", "T1", "", "no link", "", "", None, None), (1, 0, "S", "T1", "http://b", None, "sum", "", "bad", "2026-02-03T04:05:06Z")],
        "feed_order int, entry_order int, source_name string, tier string, link string, title string, summary string, content string, published string, updated string",
    )
    got = {r.source_url: r for r in readers.feed_items(entries, now()).collect()}
    assert got.keys() == {"http://a", "http://b"} and got["http://a"].title == "T" and got["http://a"].body_text == "body" and got["http://a"].evidence_tier == "T2"
    assert got["http://b"].published_at.isoformat().startswith("2026-02-03T04:05:06")
    rss = '<rss xmlns:c="urn:c"><channel><title>F</title><item><title>One</title><link>http://r/1</link><description>d &amp; e</description><pubDate>Tue, 06 Jan 2026 10:00:00 GMT</pubDate></item><item><title>no link</title></item></channel></rss>'
    atom = '<?xml version="1.0" encoding="utf-8"?><feed xmlns="http://www.w3.org/2005/Atom"><entry><title>Two</title><link rel="self" href="http://a/self"/><link href="http://a/2"/><content>c</content><updated>2026-02-03T04:05:06Z</updated></entry></feed>'
    feeds = readers.feed_registry(spark, [{"name": "R", "url": "u1"}, {"name": "Bad", "url": "u2", "tier": "T1"}, {"url": "u3", "tier": "T1"}, {"name": "Evil", "url": "u4"}])
    landed = spark.createDataFrame([("u1", rss), ("u2", "<rss><item>"), ("u3", atom), ("u4", "<!DOCTYPE x [<!ENTITY a 'b'>]><rss/>")], "url string, xml string")
    polled = {r.source_url: (r.title, r.body_text, r.source_name, r.evidence_tier, r.published_at.isoformat()) for r in readers.poll(feeds, landed, now()).collect()}
    assert polled == {"http://r/1": ("One", "d & e", "R", "T2", "2026-01-06T10:00:00"), "http://a/2": ("Two", "c", "u3", "T1", "2026-02-03T04:05:06")}
    assert {r.source_name for r in readers.feed_failures(feeds.join(landed, "url")).collect()} == {"Bad", "Evil"}
    assert readers.poll_feed(spark, landed, "u1", now()).first().source_name == "u1"


def test_streaming_intake(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    line = lambda i, t: json.dumps({"item_id": i, "source_url": "u", "title": t, "captured_at": "2026-01-01T00:00:00Z"})
    (src / "1.json").write_text(line("a", "one") + "\n" + line("b", "two") + "\n" + line("a", "one") + "\n")
    for _ in range(2):
        ingest.intake(ingest.raw_items(spark, str(src)), str(tmp_path / "table"), str(tmp_path / "cp")).awaitTermination()
        (src / "2.json").write_text(line("c", "three") + "\n")
    assert by(sinks.latest(spark, str(tmp_path / "table")), "item_id", "title") == {"a": "one", "b": "two", "c": "three"}


def folds(df):
    """How often a plan folds texts."""
    return df._jdf.queryExecution().optimizedPlan().toString().count("octet_length")


def test_items_are_described_from_one_folded_text(spark):
    items = spark.createDataFrame([("a", "Flood: PRASA to award contract", "El señor paga $1,500 de emergencia", "PRASA"), ("b", None, None, None)], "item_id string, title string, body_text string, source_name string")
    for lexicon in ({"X": ["flood"], "Y": ["señor"]}, {"X": ["flood"]}):
        apart = classify.with_flags(classify.enrich(classify.classify(items, lexicon)))
        whole = classify.described(items, lexicon)
        assert whole.columns == apart.columns and sorted(map(str, whole.collect())) == sorted(map(str, apart.collect()))
    assert folds(classify.with_flags(items)) == 1
    assert folds(whole) == folds(classify.enrich(items)) == 4  # the text, and for recipients title, source and names
