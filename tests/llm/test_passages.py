import random
import re
from collections import Counter

import corpus_pipeline
from signalloom.llm import suffix_dedup as module
from signalloom.llm.suffix_dedup import cut_repeats

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, words):
    """Texts less the words, and the blanks between them, of windows that start twice."""
    places = [list(WORD.finditer(t or "")) for _, t in rows]
    windows = [[tuple(m[0] for m in p[i : i + words]) for i in range(len(p) - words + 1)] for p in places]
    starts, out = Counter(w for of in windows for w in of), []
    for (doc_id, text), p, of in zip(rows, places, windows):
        gone = bytearray(len(text or ""))
        for i, w in enumerate(of):
            if starts[w] > 1:
                a, b = p[i].start(), p[i + words - 1].end()
                gone[a:b] = b"\1" * (b - a)
        left = "".join(c for c, g in zip(text or "", gone) if not g)
        if not any(gone) or WORD.search(left):
            out.append((doc_id, None if text is None else left, len(left)))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)


def test_passages_of_over_fifty_short_words(spark):
    rng, rows = random.Random(3), []
    own = lambda: " ".join(f"{rng.getrandbits(32):x}" for _ in range(30))
    passage = {n: " ".join("".join(rng.choices("abcde", k=rng.randint(1, 4))) for _ in range(n)) for n in (50, 51, 60)}
    for n, p in passage.items():
        rows += [(n, f"{own()} {p} {own()}"), (n + 100, f"{own()}\n{p}\t{own()}")]
    assert len(passage[60]) < 400
    left = {r.doc_id: r.text for r in corpus_pipeline.without_repeats(spark, frame(spark, rows), "").collect()}
    assert {i for i, t in rows if left[i] == t} == {50, 150}
    assert all(len(left[i].split()) == 60 for i in (51, 151, 60, 160))


def test_against_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    passages = [[rng.choice("é a bc ß def".split()) + str(rng.randrange(30)) for _ in range(k)] for k in (29, 30, 31, 80)]
    rows = []
    for i in range(80):
        t = [str(rng.getrandbits(20)) for _ in range(rng.randint(0, 60))]
        for p in passages:
            if rng.random() < 0.4:
                at, a = rng.randint(0, len(t)), rng.randint(0, 3)
                t[at:at] = p[a : len(p) - rng.randint(0, 3)]
        rows.append((i, "".join(w + rng.choice([" ", "\n", "\x0b \t"]) for w in t)))
    rows += [(100, None), (101, ""), (102, "ab " * 200), (103, "z y " * 70), (104, " ".join(passages[3])), (None, rows[0][1]), (None, None), rows[3], rows[3]]
    for bits in (20, 6):
        monkeypatch.setattr(module, "PLACE_BITS", bits)
        got = cut_repeats(frame(spark, rows), words=30).select("doc_id", "text", "n_chars").collect()
        assert sorted(map(tuple, got), key=str) == sorted(brute(rows, 30), key=str)


def test_null_texts_and_other_columns_stay(spark):
    rows = [(1, None, 7, "a"), (1, None, 7, "a"), (None, "x " * 60, 9, "b"), (2, "y z", 3, None), (3, "", 0, "c"), (4, " \t", 2, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, spans string")
    got = cut_repeats(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted((r for r in rows if r[0] is not None), key=str)
    assert cut_repeats(docs.limit(0)).collect() == []
