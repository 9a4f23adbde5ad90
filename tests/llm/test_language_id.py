import random
import zlib

from signalloom.llm.language_id import identify, only_known

SCHEMA = "doc_id long, text string, lang string, score double, lang_pred string"
SYLLABLES = {"en": "the ing and tion of re".split(), "de": "der ung sch ein ß zu".split(), "fr": "le eau tion é ou ai".split()}


def make(rng, n):
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        words = ["".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(4, 60))]
        rows.append((i, " ".join(words), lang))
    return rows


def run(spark, rows):
    return identify(spark.createDataFrame([(*r, 0.0, "x") for r in rows], SCHEMA)).collect()


def test_held_out_accuracy_and_calibration(spark):
    rows = make(random.Random(1), 1200)
    rows += [(5000, None, "en"), (5001, "", "en"), (5002, "12 34 !", "fr"), (None, "the ing", None), (5003, "der ung " * 40_000, None), rows[0], rows[0]]
    got = run(spark, rows)
    assert len(got) == len(rows)
    truth = {i: lang for i, _, lang in rows}
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 5000]
    assert all((zlib.crc32(str(r.doc_id).encode()) % 3 == 1) == r.held_out for r in got if r.doc_id is not None)
    right = sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held)
    assert right > 0.98 and abs(sum(r.score for r in held) / len(held) - right) < 0.05
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (5000, 5001, 5002)) and by[5003].lang_pred == "de"


def test_nothing_to_learn(spark):
    assert run(spark, []) == []
    assert [r.lang_pred for r in run(spark, [(1, "the", None), (2, None, "en")])] == ["und"] * 2


def test_filter_keeps_columns(spark):
    rows = make(random.Random(2), 300) + [(900, "123", "en"), (901, None, "en")]
    df = spark.createDataFrame([(*r, 0.0, "x") for r in rows], SCHEMA)
    kept = only_known(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == set(range(300))
