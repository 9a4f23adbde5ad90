import random
import re
from collections import Counter, defaultdict

import pytest

from signalloom.llm import divergence
from signalloom.llm.divergence import audit

SCHEMA = "doc_id long, text string, lang string, source string, term string, count long, value long, v int"


def brute(rows, least_docs=3, top=200):
    df, count, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]
        df[lang].update(set(words))
        count[lang, source].update(words)
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in df[lang].items() if n >= least_docs]
        v = len(kept)
        count[lang, None] = sum((count[lang, s] for s in sources), Counter())
        n = {s: sum(count[lang, s][t] for t in kept) for s in [*sources, None]}
        share = {s: {t: 1 + 10**9 * (count[lang, s][t] + 1) // (n[s] + v) for t in kept} for s in [*sources, None]}
        gap = lambda s, t, o: (share[s][t] - share[o][t]) ** 2 // share[o][t]
        for s in sources:
            far = sorted((-sum(gap(s, t, o) for t in kept), o.encode()) for o in sources if o != s)
            used = sorted((-gap(s, t, None), t.encode()) for t in kept if count[lang, s][t] and share[s][t] > share[None][t])[:top]
            out += [(lang, s, part, item.decode(), -value, i) for part, found in (("pair", far), ("term", used)) for i, (value, item) in enumerate(found, 1)]
    return sorted(out)


def run(spark, rows, **given):
    df = spark.createDataFrame([(i, *r, "x", 1, 2, 3) for i, r in enumerate(rows)], SCHEMA)
    got = audit(df, **given)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    want = brute(rows, **given)
    assert sorted(map(tuple, got.collect())) == want
    return want


def some(seed, n, langs=("en", "de", None, ""), sources=("a", "b", "Ä", None, "b2")):
    draw = random.Random(seed)
    words = [draw.choice(["un", "ber", "é", "日", "TH", "x"]) * draw.randint(1, 3) + draw.choice(["a", "ö", "", "Z"]) for _ in range(60)]
    word = lambda: words[int(draw.random() ** 2 * len(words))]
    return [(draw.choice(["", " ", "-"]).join(word() + draw.choice([" ", ".", "1", "\n", "’", "'"]) for _ in range(draw.randint(0, 60))), draw.choice(langs), draw.choice(sources)) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    assert any(r[2] == "pair" and r[4] > 0 for r in run(spark, some(seed, 150)))


def test_several_automata_and_small_hand_overs(spark, monkeypatch):
    monkeypatch.setattr(divergence, "TERMS", 20)
    monkeypatch.setattr(divergence, "HELD", 30)
    monkeypatch.setattr(divergence, "FOUND", 100)
    rows = some(3, 150, langs=("en", "de", "fr", "es", None)) + [("far away far away", "nl", "z")] * 3
    terms = divergence.kept_terms(divergence.read_as(spark.createDataFrame(rows, "text string, lang string, source string"), "text", "lang", "source"), 3)
    automaton, serves = divergence.dealt_terms(terms)
    assert len(serves) > 3 and len(terms.select(automaton.alias("a")).distinct().collect()) > 3
    run(spark, rows)


def test_ranks_end_at_the_top(spark):
    assert max(r[5] for r in run(spark, some(4, 200, langs=("en",)), top=4) if r[2] == "term") == 4


def test_hard_rows(spark):
    same = [("word again", "en", "a")] * 5
    run(spark, [(None, None, None), ("", "en", "a"), ("  \n", "en", "b"), ("123", "xx", "only"), ("x " * 30_000 + "y", "en", "a"), *same, ("Word AGAIN ÄPFEL äpfel", "en", "b"), ("lone", "de", "c"), ("lone", "de", "d")])
    run(spark, [("one two", "en", "a")] * 3)  # one source: no pairs
    run(spark, [("rare", "en", "a"), ("seldom", "en", "b")])  # no kept term: values of 0
    assert audit(spark.createDataFrame([], SCHEMA)).collect() == []
