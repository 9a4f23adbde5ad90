import random
import re

import xxhash

from signalloom.llm import simhash as module
from signalloom.llm.components import components
from signalloom.llm.simhash import as_hex, links, near_duplicates

SCHEMA = "doc_id long, text string, fp long, root string, component_id long"


def brute_fp(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_documents(spark):
    rng = random.Random(2)
    base = [rng.choices("alpha Beta gamma d é e1 f".split(), k=rng.randint(0, 120)) for _ in range(60)]
    rows = []
    for i in range(300):
        w = list(rng.choice(base))
        if w and rng.random() < 0.6:
            w[rng.randrange(len(w))] = "new%d" % i
        rows.append((i * 3 + 1, rng.choice([" ", "\n", "\x0b \t"]).join(w)))
    rows += [(5000, None), (5001, ""), (5002, " \n"), (None, "alpha"), (None, None), rows[4], rows[4], (5003, "w " * 40_000), (5004, "w " * 40_001)]
    got = near_duplicates(spark.createDataFrame([(*r, 1, "r", 2) for r in rows], SCHEMA)).select("doc_id", as_hex(module.F.col("fp")).alias("fp"), "component_id").collect()
    fps = [brute_fp(t) for _, t in rows]
    group = brute_components(fps)
    least = {}
    for (i, _), g in zip(rows, group):
        least[g] = min((x for x in (least.get(g), i) if x is not None), default=None)
    key = lambda r: (r[1], r[0] is not None, r[0] or 0, str(r[2]))
    assert sorted((tuple(r) for r in got), key=key) == sorted(((i, f"{f:016x}", least[g]) for (i, _), f, g in zip(rows, fps, group)), key=key)
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_links_join_up_all_close_pairs_in_crowds_too(spark, monkeypatch):
    rng = random.Random(7)
    fps = {rng.getrandbits(64) for _ in range(200)}
    for f in list(fps)[:40]:
        for _ in range(6):
            fps.add(f ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64))
    crowd = rng.getrandbits(64)
    fps |= {crowd ^ 1 << i ^ 1 << j for i in range(0, 64, 4) for j in range(i)}
    fps = sorted(fps)
    for most in (256, 3):
        monkeypatch.setattr(module, "CROWD", most)
        found = links(spark.createDataFrame([(signed(f),) for f in fps], "fp long"))
        assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 2 for r in found.collect())
        root = {r.node: r.root for r in components(found).collect()}
        group = brute_components(fps)
        mine = [root.get(signed(f), signed(f)) for f in fps]
        assert len(set(zip(group, mine))) == len(set(group)) == len(set(mine))


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(0, 200)] + [(300, 299), (299, 299), (300, 299)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(201)} | {299: 299, 300: 299}
