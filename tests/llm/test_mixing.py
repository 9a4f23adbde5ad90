import math
import random
import re
from collections import Counter, defaultdict

import xxhash
from pyspark.sql import functions as F

from signalloom.llm import mixing
from signalloom.llm.mixing import deal, mix, mixed_documents, split_quotas, targets

SCHEMA = "doc_id long, text string, source string, n_chars long, size long, words long"


def make(rows):
    return [(i, t, s, 1, 2, 3) for i, t, s in rows]


def brute_targets(size, weights=(5, 2, 1), most=3):
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None] * (None in size)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, total = set(), sum(size.values())
    while True:
        left = total - sum(most * size[s] for s in full)
        wsum = sum(weight[s] for s in order if s not in full)
        got = {s: most * size[s] if s in full else left * weight[s] / wsum for s in order}
        over = {s for s in order if s not in full and got[s] > most * size[s] * (1 + 1e-12)}
        if not over:
            return got
        full |= over


def spark_hash(*values):
    """xxhash64 of longs and ("int", value) pairs, null ones left out."""
    h = 42
    for v in values:
        if v is not None:
            raw = v[1].to_bytes(4, "little", signed=True) if isinstance(v, tuple) else v.to_bytes(8, "little", signed=True)
            h = xxhash.xxh64_intdigest(raw, h)
    return h - (1 << 64) if h >> 63 else h


def brute_copies(rows, target, most=3, seed=42, leaf=64):
    """How often each (id, source, size) is taken, by plain loops over blocks, leaves and documents."""
    times = Counter((i, s, words(t)) for i, t, s in rows)
    out = {}
    order = sorted((s for s in target if s is not None), key=lambda s: s.encode()) + [None] * (None in target)
    for rank, source in enumerate(order, 1):
        docs = [d for d in times if d[1] == source]
        weigh = lambda ds: sum(d[2] * times[d] for d in ds)
        whole = weigh(docs)
        passes = min(int(target[source] / whole + 1e-12), most) if whole else 0
        need = target[source] - passes * whole if whole and passes < most else 0.0
        out.update({d: passes for d in docs})

        def filled(docs, parts, salt, need):
            """Parts that fit; the documents of the part that the need ends in, and what is missing of it."""
            of = defaultdict(list)
            for d in docs:
                of[spark_hash(d[0], ("int", seed + salt)) % parts].append(d)
            taken, upto = [], 0
            for b in sorted(of, key=lambda b: (spark_hash(("int", rank), b, ("int", seed + salt + 1)), b)):
                lack, upto = need - upto, upto + weigh(of[b])
                if upto <= need:
                    taken += of[b]
                elif lack > 0:
                    return taken, of[b], lack
            return taken, [], 0

        taken, cut, lack = filled(docs, max(1, math.ceil(math.sqrt(len(docs) / leaf))), 1, need)
        if cut:
            more, last, lack = filled(cut, max(1, math.ceil(len(cut) / leaf)), 3, lack)
            taken += more
            for d in sorted(last, key=lambda d: (d[2] * times[d], d[0] is not None, d[0] or 0), reverse=True):
                if d[2] * times[d] <= lack:
                    lack -= d[2] * times[d]
                    taken.append(d)
        for d in taken:
            out[d] += 1
    return out


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def test_targets_and_taken_words(spark):
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        s = rng.choices(["a", "b", "Z", "é", "tiny", None], [1000, 400, 300, 100, 5, 60])[0]
        rows.append((i, "w " * rng.randint(0, 60), s))
    rows += [(1, rows[1][1], rows[1][2])] * 3 + [(None, "x y z", "a"), (None, None, "a"), (9000, None, None), (9001, "", "empty"), (9002, "v " * 5000, "b")]
    got = mix(spark.createDataFrame(make(rows), SCHEMA)).collect()
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((i, words(t)) for i, t, s in rows)
    size, taken, least = defaultdict(int), defaultdict(int), {}
    for i, t, s in rows:
        size[s] += words(t)
    want = brute_targets(size)
    for r in got:
        assert r.source_size == size[r.source] and abs(r.target - want[r.source]) < 1e-6 * (1 + r.target)
        assert 0 <= r.taken <= 3 * r["size"] and len(r.shards) == r.copies and all(0 <= x < 16 for x in r.shards)
        taken[r.source] += r.taken
    for s in want:
        assert want[s] - 60 <= taken[s] <= want[s] + 1e-6, (s, want[s], taken[s])
    again = mix(spark.createDataFrame(make(rows[::-1]), SCHEMA)).collect()
    assert Counter(map(str, got)) == Counter(map(str, again))
    assert {(r.doc_id, r.source, r["size"]): r.copies for r in got} == brute_copies(rows, want)


def test_copies_are_dealt_to_shards_and_shuffled(spark):
    rng = random.Random(6)
    rows = [(i, "w " * rng.randint(1, 60), rng.choice("aab")) for i in range(2000)] + [(None, "x y", "a"), (5, None, "a")]
    mixed = mix(spark.createDataFrame(make(rows), SCHEMA), shards=5).cache()
    want = Counter((r.doc_id, r.source, r["size"], s) for r in mixed.collect() for s in r.shards)
    dealt = deal(mixed).withColumn("at", F.monotonically_increasing_id()).collect()
    assert Counter((r.doc_id, r.source, r["size"], r.shard) for r in dealt) == want and len(want) > 1000
    by_shard = defaultdict(list)
    for r in sorted(dealt, key=lambda r: r.at):
        by_shard[r.shard].append((r.order, r.doc_id))
    assert sorted(by_shard) == list(range(5))
    for of in by_shard.values():
        assert of == sorted(of, key=lambda x: x[0])
        ids = [i for _, i in of if i is not None]
        rising = sum(a < b for a, b in zip(ids, ids[1:])) / len(ids)
        assert 0.4 < rising < 0.6  # in no order of ids
    assert all(len(r.shards) == len(r.orders) == r.copies for r in mixed.collect())


def test_mixed_documents_keep_their_columns(spark):
    rows = [(i, f"word {i} " * 5, "a" if i % 3 else "b", i, i, i) for i in range(300)] + [(1, None, None, 1, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size long, row long, shards long")
    copies = {(r.doc_id, r.source): r.copies for r in mix(docs).collect()}
    got = mixed_documents(docs)
    assert got.columns == docs.columns
    assert Counter(map(tuple, got.collect())) == Counter({r: copies[r[0], r[2]] for r in rows if copies[r[0], r[2]]})
    assert mixed_documents(docs.limit(0)).collect() == []


def test_quotas_stay_exact_and_shards_even(spark):
    quotas = [(1, 100), (2, 7), (3, 0), (4, 33)]
    got = split_quotas(spark.createDataFrame(quotas, "rank int, quota long"), 6, 1).collect()
    of = defaultdict(int)
    shard = defaultdict(int)
    for r in got:
        assert r.quota >= 0
        of[r["rank"]] += r.quota
        shard[r.first] += r.quota
    assert dict(of) == {r: q for r, q in quotas if q} and sorted(shard) == list(range(6))
    assert max(shard.values()) - min(shard.values()) <= 2


def test_no_rows_and_no_words(spark):
    assert mix(spark.createDataFrame([], SCHEMA)).collect() == []
    (r,) = mix(spark.createDataFrame(make([(1, None, None)]), SCHEMA)).collect()
    assert r.taken == 0 and r.target == 0


def test_full_sources_hand_on_what_they_leave(spark):
    sizes = [(i, s, n, 1) for i, (s, n) in enumerate([("a", 1), ("b", 2), ("c", 5000), ("d", 3), ("e", 900), (None, 4000)])]
    got = {r.source: r.target for r in targets(spark.createDataFrame(sizes, "doc_id long, source string, size long, times long"), [5, 2, 1], 3).collect()}
    want = brute_targets({s: n for _, s, n, _ in sizes})
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_draws_do_not_depend_on_how_blocks_fall_into_parts(spark, monkeypatch):
    quotas = spark.createDataFrame([(r, 1 + r * r % 40) for r in range(1, 200)], "rank int, quota long")
    rows = lambda: sorted(map(tuple, split_quotas(quotas, 7, 3).collect()))
    want = rows()
    monkeypatch.setattr(mixing, "PART", 5)
    monkeypatch.setattr(mixing, "FEW_NODES", 0)
    assert rows() == want


def test_draws_are_hypergeometric(spark):
    """Of 60 and 20 blocks 40 are drawn: 30 of the first on average, with a variance of 40 * 3/4 * 1/4 * 40/79."""
    nodes = [(r, q, 2 * i, 2) for i in range(1000) for r, q in ((1, 60), (2, 20))]
    rows = mixing.halved(spark.createDataFrame(nodes, "rank int, quota long, first int, k int"), 1000, 3).collect()
    got = [r.quota for r in rows if r["rank"] == 1 and r.first % 2 == 0]
    mean = sum(got) / len(got)
    assert len(got) == 1000 and abs(mean - 30) < 0.25 and 3.1 < sum((x - mean) ** 2 for x in got) / len(got) < 4.5


def test_targets_by_runs_of_sources(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RUN", 3)
    rng = random.Random(8)
    size = {f"s{i}": rng.choice([1, 5, 70, 2000]) for i in range(50)}
    rows = [(i, s, n, 1) for i, (s, n) in enumerate(size.items())]
    got = {r.source: r.target for r in targets(spark.createDataFrame(rows, "doc_id long, source string, size long, times long"), [5, 2, 1], 3).collect()}
    want = brute_targets(size)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 * (1 + want[s]) for s in want)


def test_a_hundred_thousand_sources(spark):
    docs = spark.range(200_000).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', cast(1 + id % 7 as int))").alias("text"), F.expr("concat('s', id % 100000)").alias("source"))
    per = mix(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.first("source_size").alias("size"), F.max(F.size("shards")).alias("copies"))
    n, words, taken, over = per.agg(F.count(F.lit(1)), F.sum("size"), F.sum("taken"), F.count_if((F.col("taken") > F.col("target") + 1e-6) | (F.col("copies") > 3))).first()
    assert n == 100_000 and over == 0 and 0.7 * words < taken <= words


def test_few_shards_are_dealt_to_all_partitions(spark):
    rows = [(i, "w " * (1 + i % 40), "ab"[i % 2]) for i in range(4000)]
    mixed = mix(spark.createDataFrame(make(rows), SCHEMA), shards=2).cache()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    try:
        dealt = deal(mixed).withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    per = Counter(r.part for r in dealt)
    assert len(per) == 16 and max(per.values()) < 1.5 * len(dealt) / 16
    assert [(r.shard, r.order) for r in sorted(dealt, key=lambda r: r.at)] == sorted((r.shard, r.order) for r in dealt)
    assert sorted(r.shard for r in dealt) == sorted(s for r in mixed.collect() for s in r.shards)
