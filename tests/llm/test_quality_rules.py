import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from signalloom.llm import quality_rules
from signalloom.llm.quality_rules import RATES, bucket, fences, judge, merged, sketches

SCHEMA = "doc_id long, text string, lang string, source string, n_words long, level string, bucket int"


def measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    n = Counter(windows)
    covered = {j for i, w in enumerate(windows) if n[w] > 1 for j in range(i, i + 5)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall("[#*$%&|<>]", text)), "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered)}


def floor_bucket(v):
    low = max(0, v.bit_length() - 7)
    return v >> low << low


def brute(rows, enough=64):
    seen = [measures(r[1]) for r in rows]
    base = [m["n_words"] < 10 or 100 * m["n_repeat_words"] > 20 * m["n_words"] for m in seen]
    keys = [((r[2], r[3]), (r[2],), ()) for r in rows]
    limits = {}
    for key in {k for ks, failed in zip(keys, base) if not failed for k in ks}:
        mine = [m for m, ks, failed in zip(seen, keys, base) if key in ks and not failed]
        found = {}
        for r in RATES:
            v = sorted(floor_bucket(1000 * m[r.count] // m[r.per]) for m in mine if m[r.per])
            if v:
                q1, q3 = v[-(-len(v) // 4) - 1], v[-(-3 * len(v) // 4) - 1]
                found[r.name] = max(0, q1 - 3 * max(q3 - q1, r.least)), q3 + 3 * max(q3 - q1, r.least)
        limits[key] = len(mine), found
    out = []
    for r, m, ks, failed in zip(rows, seen, keys, base):
        level, names = None, None
        if not failed:
            level = next(i for i, k in enumerate(ks) if limits[k][0] >= enough or i == 2)
            names = []
            for rate in RATES:
                low, high = limits[ks[level]][1][rate.name]
                over, under = 1000 * m[rate.count] - m[rate.per] * high, m[rate.per] * low - 1000 * m[rate.count]
                if over > 0 and over**2 > 16000 * m[rate.per] * max(high, 1) or rate.both and under > 0 and under**2 > 16000 * m[rate.per] * max(low, 1):
                    names.append(rate.name)
        out.append((r[0], m["n_words"], m["word_chars"], m["n_symbols"], m["n_dup_lines"], m["n_repeat_words"], failed, names == [], level, names))
    return sorted(out, key=repr)


def run(spark, rows, **given):
    got = judge(spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA))
    want = brute(rows, **given)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    return want


def prose(draw, n, of="abcdefghij", longest=9):
    return "".join("".join(draw.choice(of) for _ in range(draw.randint(1, longest))) + draw.choice([" ", " ", " ", ". ", "\n", "\t"]) for _ in range(n))


def some(seed, n):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        text = prose(draw, draw.choice([3, 12, 80, 300]))
        kind = draw.random()
        if kind < 0.08:
            text = re.sub(r"\b(\w+)\b", lambda m: m[1] + "##$", text)
        elif kind < 0.14:
            text = re.sub(r" ", "", text)
        elif kind < 0.2:
            text += "the same line\n" * 9
        elif kind < 0.25:
            text += (prose(draw, 7) + "\n") * draw.randint(2, 4)
        rows.append((i, text, draw.choice(["en", "en", "en", "de", None, f"x{i % 9}"]), draw.choice(["a", "a", "b", None, f"s{i % 40}"])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed, monkeypatch):
    found = run(spark, some(seed, 700))
    assert {r[8] for r in found} == {None, 0, 1, 2}
    assert {n for r in found for n in r[9] or ()} >= {"letters", "symbols"}


def test_windows_that_overlap_and_meet(spark):
    draw = random.Random(3)
    texts = [" ".join(draw.choice("ab") for _ in range(n)) for n in range(4, 40)] + ["a " * 5, "a " * 6, "a b c d e a b c d e", "x a b c d e y a b c d e z", "a b c d e f a b c d e f g", "a\nb\nc d  e q a b c d e"]
    run(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])


def test_hard_rows(spark):
    long = prose(random.Random(4), 30_000)
    rows = [(None, None, None, None), (1, "", "en", "a"), (2, " \n\t\x0b", "en", "a"), (3, "one", "en", "a"), (2**60, long, "en", "a"), (5, "w " * 3000, "en", "a"), (6, "日本語 テキスト " * 3 + " nbsp  em", "ja", "a")]
    rows += [(7, prose(random.Random(6), 20), "en", "a")] * 3
    run(spark, rows)
    assert judge(spark.createDataFrame([], SCHEMA)).collect() == []
    assert [r.kept for r in judge(spark.createDataFrame([(*rows[0], 1, "x", 2)], SCHEMA)).collect()] == [False]


def test_sketches_merge_in_any_order(spark):
    draw = random.Random(7)
    rows = [(draw.choice("ab"), draw.randint(50, 60), draw.randint(200, 300), draw.randint(0, 99), draw.randint(1, 9), draw.randint(0, 3), draw.randint(0, 9)) for _ in range(400)]
    df = spark.createDataFrame(rows, "part string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long")
    key = lambda d: sorted(map(tuple, d.select("rate", "bucket", "n").collect()))
    assert key(merged(sketches(df, ["part"]), [])) == key(sketches(df, []))
    made = fences(sketches(df, []), []).first()
    share = sorted(1000 * r[2] // r[1] for r in rows)
    assert made.n_docs == 400 and abs((made.high_letters - made.low_letters) / 7 - (share[299] - share[99])) < share[299] / 16


def test_buckets(spark):
    values = [0, 1, 127, 128, 129, 255, 256, 1000, 12345, 10**12 + 7]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v long").select(bucket(F.col("v"))).collect()]
    assert got == [floor_bucket(v) for v in values] and all(v * 63 <= b * 64 <= v * 64 for v, b in zip(values, got))


def test_native(spark):
    rows = spark.createDataFrame([(1, "a b", "en", "s", 1, "x", 2)], SCHEMA)
    assert quality_rules.WINDOW == 5
    plan = judge(rows)._jdf.queryExecution().executedPlan().toString() + quality_rules.measured(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
