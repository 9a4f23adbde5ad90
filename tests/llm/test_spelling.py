import random
import re
import zlib
from collections import Counter

import pytest

from signalloom.llm import spelling
from signalloom.llm.spelling import variants

SCHEMA = "doc_id long, text string, n long, word string, rank int"


def apart(a, b):
    """Whether the words differ by exactly one inserted, deleted or replaced letter."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, least=7, at_least=2, ratio=10):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += len(run) >= least
    words = sorted(w for w, k in n.items() if k >= at_least)
    near = {w: [v for v in words if v != w and abs(len(v) - len(w)) < 2 and apart(v, w)] for w in words}
    best = {w: min(near[w], key=lambda v: (-n[v], v)) for w in words if near[w]}
    form = {w: b for w, b in best.items() if n[b] >= ratio * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in words)


def run(spark, rows, **given):
    got = variants(spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA), **given)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute(rows, **given)
    assert sorted(map(tuple, got.collect())) == want
    return {w[0]: w for w in want}


def texts(seed, n_words, of="aabé", longest=11):
    draw = random.Random(seed)
    words = ["".join(draw.choice(of) for _ in range(draw.randint(6, longest))) for _ in range(n_words)]
    return [(i, " ".join(draw.choice(words[: draw.choice([5, 50, n_words])]) for _ in range(draw.randint(0, 400)))) for i in range(60)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force_on_dense_words(spark, seed):
    found = run(spark, texts(seed, 600))
    assert sum(r[4] > 1 for r in found.values()) > 50 and any(r[1] for r in found.values())


def test_forms_lead_on_to_a_root(spark):
    often = [("government", 3000), ("goverment", 200), ("govermant", 15), ("govermxant", 1), ("gouvernment", 12)]
    rows = [(i * 1000 + k, w) for i, (w, n) in enumerate(often) for k in range(n)] + [(None, "govermxant Govermxant")]
    found = run(spark, rows)
    assert found["govermant"][1:3] == ("goverment", "government") and found["gouvernment"][1] == "government" and found["goverment"][1] == "government"


def test_paths_of_forms_of_any_length(spark):
    """The second form's form has a form, and so on, with a ratio of one that lets equals form no circle."""
    rows = [(1000 * i + k, "a" * (7 + i) + "Z") for i in range(9) for k in range(2 * 3**i if i < 6 else 2 * 3**5 * (i - 4))]
    run(spark, rows, ratio=2)


def test_hard_rows(spark):
    rows = [(None, None), (1, ""), (2, "  \n"), (3, "short run of six in"), (4, "ÀÉÎÕÜßÿ ÀÉÎÕÜßÿ àÉÎÕÜßÿ àÉÎÕÜßÿ Mañanas×÷ mañanas×÷"), (4, "Repeated rows"), (4, "Repeated rows"), (2**60, "repeated—repeater repeater’s REPEATED"), (-5, "日本語日本語日本語 повторение повторение")]
    found = run(spark, rows)
    assert "àÉÎÕÜßÿ" in found and found["àÉÎÕÜßÿ"][4] == 1
    rows = [(None, None), (7, "")]
    assert variants(spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)).collect() == []
    assert variants(spark.createDataFrame([], SCHEMA)).collect() == []


def test_very_long_words(spark):
    long = "".join(random.Random(5).choice("abcdeé") for _ in range(3000))
    kinds = [long, long[:-1], long[:1500] + "x" + long[1501:], long + "b", "b" + long, "q" * 70, "q" * 69, "q" * 65, "q" * 64, "q" * 66]
    rows = [(i, w) for i, w in enumerate(kinds * 3)]
    found = run(spark, rows, at_least=1)
    assert found[long][4] >= 4 and found["q" * 65][4] >= 2


def test_keys_beyond_a_length_are_hashed(spark, monkeypatch):
    monkeypatch.setattr(spelling, "KEY", 3)
    run(spark, texts(3, 300))
