import json

from signalloom.operators.classify import answered, classify, classify_with_scorer, understood

LEXICON = {"A": ["apple"], "B": ["berry"], "C": ["corn"]}
ITEMS = [(str(i), t, b) for i, (t, b) in enumerate([("apple", "berry"), ("apple", "x"), ("plain", "bad one"), ("corn", "bad two"), (None, None), ("odd", "text"), ("corn", "y" * 900), ("none", "labels")])]


def made(answer):
    def make():
        seen = []

        def scorer(titles, bodies):
            seen.extend(zip(titles, bodies))
            if any("bad" in b for b in bodies):
                raise RuntimeError("cannot take it")
            return [answer(t, b) for t, b in zip(titles, bodies)]

        return scorer

    return make


def run(spark, make, **given):
    df = spark.createDataFrame(ITEMS, "item_id string, title string, body_text string")
    rows = classify_with_scorer(df, make, LEXICON, **given).orderBy("item_id").collect()
    return [(r.labels, r.confidence, r.scorer_error) for r in rows], rows


def answer(title, body):
    if title == "odd":
        return "no JSON"
    if title == "none":
        return {"labels": ["X", 5, None]}
    return json.dumps({"labels": ["B", "X"], "confidence": len(body) / 1000, "reasoning": "why"})


def test_items_that_fail_leave_the_others(spark):
    got, rows = run(spark, made(answer))
    assert got[0] == (["A", "B"], 0.85, None)  # two keyword labels: not asked
    assert got[1] == (["B", "A"], 0.001, None)
    assert got[2][:2] == (["UNCLASSIFIED"], 0.3) and got[2][2] == "RuntimeError: cannot take it"
    assert got[3][:2] == (["C"], 0.6) and got[3][2] == "RuntimeError: cannot take it"
    assert got[4] == (["B"], 0.0, None)
    assert got[5][:2] == (["UNCLASSIFIED"], 0.3) and got[5][2].startswith("JSONDecodeError")
    assert got[6] == (["B", "C"], 0.8, None)  # the first 800 characters
    assert got[7] == (["UNCLASSIFIED"], 0.5, None)
    assert rows[3].classifier_reasoning == "keyword label alone (no answer: RuntimeError: cannot take it)" and rows[1].classifier_reasoning == "why"
    assert run(spark, made(answer), most=None)[0][6] == (["B", "C"], 0.9, None)


def test_a_scorer_that_cannot_be_made_falls_back_to_keywords(spark):
    def make():
        raise OSError("no model")

    got, rows = run(spark, make)
    plain = classify(spark.createDataFrame(ITEMS, "item_id string, title string, body_text string"), LEXICON).orderBy("item_id").collect()
    assert [(r.labels, r.confidence) for r in rows] == [(r.labels, r.confidence) for r in plain]
    assert [e for _, _, e in got] == [None, *["OSError: no model"] * 7]


def test_halves_are_asked_for():
    calls = []

    def scorer(titles, bodies):
        calls.append(len(bodies))
        if "x" in bodies:
            raise ValueError("x")
        return [{"labels": [b]} for b in bodies]

    bodies = ["a"] * 37 + ["x"] + ["b"] * 90
    got = answered(scorer, [("", b) for b in bodies])
    assert [g[3] for g in got].count("ValueError: x") == 1 and got[37][3] and [g[0] for g in got if g[0]] == [[b] for b in bodies if b != "x"]
    assert len(calls) == 1 + 2 * 7
    assert answered(lambda t, b: [], [("", "a")])[0][3] == "ValueError: 0 answers for 1 items" and answered(scorer, []) == []


def test_answers_that_make_no_sense():
    assert understood('{"labels": null}') == ([], None, "", None)
    for bad in (None, 5, "[]", "{", {"labels": ["a"], "confidence": "high"}, {"labels": 5}):
        assert understood(bad)[0] is None and understood(bad)[3]
