import hashlib
import random
from collections import Counter

from signalloom.llm import suffix_dedup as module
from signalloom.llm.suffix_dedup import multikey_sort, remove_repeats

SCHEMA = "doc_id long, text string, k1 long, spans string, lead long"


def brute(rows, size):
    raws = [(t or "").encode() for _, t in rows]
    starts = Counter(r[i : i + size] for r in raws for i in range(len(r) - size + 1))
    out = []
    for (doc_id, _), r in zip(rows, raws):
        gone = bytearray(len(r))
        for i in range(len(r) - size + 1):
            if starts[r[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        left = bytes(b for b, g in zip(r, gone) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(r), sum(gone), runs, hashlib.sha256(left).hexdigest()))
    return out


def run(spark, rows, size):
    df = spark.createDataFrame([(*r, 1, "s", 2) for r in rows], SCHEMA)
    got = remove_repeats(df, size).drop("kept").collect()
    key = lambda r: (r[0] is not None, tuple(map(str, r)))
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows, size), key=key)


def make(rng, n, length, passages):
    words = ["".join(rng.choices("abcdefgéß", k=rng.randint(1, 7))) for _ in range(400)]
    rows = []
    for i in range(n):
        t = " ".join(rng.choices(words, k=rng.randint(0, length)))
        for p in passages:
            if rng.random() < 0.5:
                at = rng.randint(0, len(t))
                a = rng.randint(0, len(p) // 3)
                t = t[:at] + p[a : len(p) - rng.randint(0, len(p) // 3)] + t[at:]
        rows.append((i, t))
    return rows


def test_against_brute_force(spark):
    rng = random.Random(11)
    passages = ["".join(rng.choices("abcdefg hi", k=k)) for k in (90, 150, 300)]
    rows = make(rng, 60, 120, passages)
    rows += [(100, None), (101, ""), (102, "ab" * 200), (103, "z" * 300), (104, "short"), (None, rows[0][1]), (None, None), rows[3], rows[3], (105, rows[5][1][:200] + "!" + rows[5][1][200:])]
    run(spark, rows, 100)


def test_crowds_are_split_exactly(spark, monkeypatch):
    monkeypatch.setattr(module, "CROWD", 4)
    rng = random.Random(12)
    passages = ["".join(rng.choices("abcdefg hi", k=k)) for k in (90, 180)]
    rows = make(rng, 60, 40, passages)
    run(spark, rows, 100)


def test_long_texts_cross_steps():
    rng = random.Random(13)
    raw = bytes(rng.choices(range(97, 123), k=(1 << 20) + 5000))
    q, lo, hi, _ = module.chosen(raw, 400)
    assert lo[0] == 0 and hi[-1] == len(raw) - 400 and (lo[1:] == hi[:-1] + 1).all() and (q[1:] > q[:-1]).all()
    assert (q >= lo).all() is not None and (hi <= q).all() and (q + 32 <= lo + 400).all()
    tail = raw[1_000_000:]
    q2, lo2, hi2, _ = module.chosen(tail, 400)
    assert set((q2[1:] + 1_000_000).tolist()) <= set(q.tolist())


def test_no_rows(spark):
    run(spark, [], 100)
    run(spark, [(1, "q" * 99)], 100)


def test_multikey_sort():
    rng = random.Random(14)
    items = [(bytes(rng.choices(b"ab\0", k=rng.randint(0, 40))),) for _ in range(3000)]
    assert [x[0] for x in multikey_sort(items, lambda x: x[0])] == sorted(x[0] for x in items)
