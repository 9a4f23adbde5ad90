import random

import numpy as np

from signalloom.llm import simhash as module
from signalloom.llm.simhash import near_copies

SCHEMA = "doc_id long, text string"


def shingles(text):
    words = (text or "").lower().split()
    return {" ".join(words[i : i + 5]) for i in range(len(words) - 4)} or ({" ".join(words)} if words else set())


def brute(rows):
    """Smallest id of each row's group by Jaccard similarity of 0.8 or more, taken transitively."""
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 5 * len(a & b) >= 4 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return {doc_id: least[find(i)] for i, (doc_id, _) in enumerate(rows)}


def run(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r.doc_id: r.component_id for r in near_copies(df).collect()} == brute(rows)


def changed(rng, words, share):
    """Words with a run of them replaced, so that about this share of the shingles stays."""
    n = max(1, round(len(words) * (1 - share)))
    at = rng.randrange(len(words) - n + 1)
    return [*words[:at], *(f"x{rng.getrandbits(40)}" for _ in range(n)), *words[at + n :]]


def test_pairs_in_a_template_group(spark, monkeypatch):
    """Texts alike to about 0.6 by a passage that all have, with true copies among them; crowded buckets, and all shingles of the passage common or none."""
    rng = random.Random(5)
    template, rows = [f"t{i}" for i in range(150)], []
    for i in range(120):
        own = [f"o{i}_{j}" for j in range(rng.randint(34, 46))]
        rows.append((2 * i, " ".join(template + own)))
        if i % 3 == 0:
            rows.append((2 * i + 1, " ".join(template + changed(rng, own, 0.8))))
    rng.shuffle(rows)
    run(spark, rows)
    monkeypatch.setattr(module, "COMMON_OF", 1)
    run(spark, rows)


def test_similarities_about_the_limit(spark):
    rng = random.Random(6)
    rows = []
    for i in range(150):
        words = [f"w{rng.getrandbits(40)}" for _ in range(rng.randint(8, 300))]
        rows += [(3 * i, " ".join(words)), (3 * i + 1, " ".join(changed(rng, words, rng.uniform(0.8, 1)))), (3 * i + 2, " ".join(words[: round(len(words) * rng.uniform(0.7, 0.95))]))]
    rows += [(900, None), (901, ""), (902, " "), (903, "a b"), (904, "A  b"), (905, "a b c d e")]
    run(spark, rows)


def test_sketches_differ_no_more_than_their_sets():
    rng = np.random.default_rng(3)
    for n, m, both in [(0, 0, 0), (0, 1, 0), (1, 1, 1), (300, 280, 260), (300, 300, 0), (9000, 9000, 8000)]:
        h = rng.integers(0, 1 << 63, n + m - both, dtype=np.uint64)
        a, b = module.sketch_of(h[:n]), module.sketch_of(h[n - both :])
        apart = int(np.bitwise_count((a ^ b).view(np.uint64)).sum())
        assert apart <= n + m - 2 * both and (apart - (n + m)) % 2 == 0


def test_other_pairs_are_all_pairs_of_different_roots():
    rng = np.random.default_rng(4)
    for kinds in (3, 40, 300):
        keys = np.sort(rng.integers(0, kinds, 600))
        nodes, roots = rng.permutation(600), rng.integers(0, 4, 600)
        n, at = rng.integers(20, 40, 600), rng.integers(0, 6, 600)
        wanted = set()
        for s, k in module.spans_of(keys):
            led = [s + i for i in module.leaders(nodes[s : s + k], n[s : s + k])]
            for i in range(s, s + k):
                for j in range(s, i):
                    fits = module.may_be_alike(n[i : i + 1], at[i : i + 1], n[j : j + 1], at[j : j + 1], 0.8)[0]
                    if fits and roots[i] != roots[j] and i not in led and j not in led:
                        wanted.add(frozenset((int(nodes[i]), int(nodes[j]))))
        found = module.gathered(module.other_pairs(keys, nodes, n, at, roots, 0.8), 50)
        assert {frozenset(p) for a, b in found for p in zip(a.tolist(), b.tolist())} == wanted


def test_stretches_of_a_bucket_make_up_all_its_pairs_that_sketches_allow():
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 1 << 63, 40, dtype=np.uint64)) for _ in range(4)]
    sets = [np.unique(np.concatenate([sets[i % 4][: rng.integers(30, 41)], rng.integers(0, 1 << 63, rng.integers(0, 8), dtype=np.uint64)])) for i in range(300)]
    keys, nodes, roots = np.sort(rng.integers(0, 12, 300)), rng.permutation(300), rng.integers(0, 5, 300)
    n, at, sketches = np.array([len(x) for x in sets]), np.zeros(300, np.int64), np.stack([module.sketch_of(x) for x in sets])
    whole = {frozenset(map(int, p)) for a, b in module.other_pairs(keys, nodes, n, at, roots, 0.8) for p in zip(a, b)}
    place = {int(x): i for i, x in enumerate(nodes)}
    apart = lambda p: sum((int(x) & (1 << 64) - 1).bit_count() for x in np.bitwise_xor(*(sketches[place[i]] for i in p)))
    wanted = {p for p in whole if apart(p) * 1.8 <= 0.2 * sum(int(n[place[i]]) for i in p) + module.SLACK}
    for stretches in ([(0, None)], [(0, 2), (2, 17), (17, 400)]):
        parts = [list(module.other_pairs(keys, nodes, n, at, roots, 0.8, sketches, low, high)) for low, high in stretches]
        found = [frozenset(map(int, p)) for part in parts for a, b in part for p in zip(a, b)]
        assert set(found) == wanted and len(found) == len(wanted) and 0 < len(wanted) < len(whole)


def test_pairs_compared_in_a_group_grow_with_its_size_only(spark, monkeypatch):
    """Texts that differ from one, which isn't among them, in a few words each; many of their pairs are alike."""
    compared, keep = [], module.keep

    def counted(df, name):
        kept = keep(df, name)
        if name.endswith("-pairs"):
            compared.append(kept.count())
        return kept

    monkeypatch.setattr(module, "keep", counted)
    monkeypatch.setattr(module, "STRETCH", 4, raising=False)
    rng, rows = random.Random(9), []
    for i in range(400):
        words = [f"w{i}" for i in range(150)]
        for j in rng.sample(range(150), min(8, max(1, round(rng.gauss(2.4, 1.4))))):
            words[j] = f"x{rng.getrandbits(40)}"
        rows.append((i, " ".join(words)))
    run(spark, rows)
    assert sum(compared) < 12 * len(rows), compared


def test_hashes_of_word_runs_tell_shingles_apart():
    rng = random.Random(9)
    texts = [" ".join("".join(rng.choices("abAB1é", k=rng.randint(1, 4))) for _ in range(rng.randint(0, 60))) for _ in range(300)] + ["", " \t\n", "a", "A\x0bb  c\n", "x" * 3000, "\u00a0 a\x1cb", "ab ba", "ba ab"]
    lower = lambda t: module.shingle_hashes(t, 5).tolist()
    names = {}
    for t in texts:
        got = module.run_of_words(t, 5).tolist()
        assert len(got) == len(lower(t))
        for ours, theirs in zip(got, lower(t)):
            assert names.setdefault(ours, theirs) == theirs
    assert len(set(names.values())) == len(names) > 5000
