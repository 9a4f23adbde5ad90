import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from signalloom.llm import lattice_lm
from signalloom.llm.lattice_lm import PRIOR, ROUNDS, UNIT, Lattice, Vocabulary, score, words_of

PATH = public_tokenizers.path("piece_bpe_32k.model")
KNOWN = Vocabulary(PATH)
SCHEMA = "doc_id long, text string, word string, c long"


def total(logs, s):
    """The sum over all segmentations, plainly."""
    if not s:
        return 1.0
    p = sum(math.exp(logs[KNOWN.whole[s[:k]]]) * total(logs, s[k:]) for k in range(1, len(s) + 1) if s[:k] in KNOWN.whole)
    if s[0] not in KNOWN.whole:
        p += math.prod(math.exp(logs[KNOWN.of_byte[b]]) for b in s[0].encode()) * total(logs, s[1:])
    return p


def cuts(s):
    """All segmentations, as lists of ids."""
    if not s:
        yield []
    for k in range(1, len(s) + 1):
        if s[:k] in KNOWN.whole:
            yield from ([KNOWN.whole[s[:k]], *rest] for rest in cuts(s[k:]))
    if s and s[0] not in KNOWN.whole:
        yield from ([*(KNOWN.of_byte[b] for b in s[0].encode()), *rest] for rest in cuts(s[1:]))


def expected(logs, counts):
    """Each piece's mean number in words, all segmentations by their probability."""
    got = np.zeros(len(logs))
    for w, times in counts.items():
        every = list(cuts("▁" + w))
        p = [math.exp(sum(logs[i] for i in ids)) for ids in every]
        for ids, x in zip(every, p, strict=True):
            for i in ids:
                got[i] += times * x / sum(p)
    return got


def test_expected_counts_are_means_over_all_segmentations(monkeypatch):
    rng = np.random.default_rng(6)
    logs = np.log(rng.random(32_000) * 1e-3)
    words = {"the": 5, "nation": 3, "étionre": 2, "x": 1, "🙂a": 4, "a🙂あ": 1, "▁a▁": 7, "nations": 100_000}
    want = expected(logs, words)
    for letters in (1 << 17, 1, 9):
        monkeypatch.setattr(lattice_lm, "LETTERS", letters)
        got = Lattice(KNOWN, logs).expected(list(words), np.array(list(words.values()))) / UNIT
        assert np.abs(got - want).max() < 1e-3 and (got > 0).sum() > 30
        assert Lattice(KNOWN, logs).log_probabilities(["the", "", "nation"]) == pytest.approx([math.log(total(logs, "▁" + w)) for w in ("the", "", "nation")])
    assert Lattice(KNOWN, logs).log_probabilities([]).tolist() == []


def test_forward_recursion_is_the_sum_over_all_segmentations():
    rng = np.random.default_rng(4)
    logs = np.log(rng.random(32_000) * 1e-3)
    lattice = Lattice(KNOWN, logs)
    for w in ("the", "nation", "étionre", "x", "", "🙂a", "あ\u0000b", "a🙂あ", "▁a▁"):
        assert math.isclose(lattice.log_probabilities([w])[0], math.log(total(logs, "▁" + w)), rel_tol=1e-9), w
    assert math.isfinite(lattice.log_probabilities(["x", "ab" * 20_000, "the"])[1])


def words(text):
    return text.encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))).split()


def test_words():
    rng = random.Random(5)
    texts = ["".join(rng.choices("aB\t\n\x0b\x0c\r \u00a0É\x1c", k=rng.randint(0, 12))) for _ in range(500)]
    for cut in (texts, ["", ""], [], ["x"]):
        distinct, numbers, sizes = words_of(pa.array(cut, pa.string()))
        known = distinct.to_pylist()
        assert len(set(known)) == len(known) and sizes.tolist() == [len(words(t)) for t in cut]
        assert [known[i] for i in numbers] == [w for t in cut for w in words(t)]


def held(i, n=10):
    return zlib.crc32(("" if i is None else str(i)).encode()) % n == 0


def run(spark, rows):
    got = score(spark.createDataFrame([(*r, "w", 1) for r in rows], SCHEMA), PATH).collect()
    c = Counter(w for i, t in rows if not held(i) for w in [*words(t or ""), None])
    n, v = sum(c.values()), len(c)
    want = []
    for i, t in rows:
        ws = [*words(t or ""), None]
        want.append((i, held(i), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 6)))
    key = lambda r: (r[0] is not None, r)
    assert sorted(((*tuple(r)[:5], round(r.base_score, 6)) for r in got), key=key) == sorted(want, key=key)
    # scores: from the prior on, the mean numbers of pieces in training words; then the sum over segmentations of each word
    prior, learnt = KNOWN.prior * PRIOR * np.count_nonzero(KNOWN.prior), np.zeros(len(KNOWN.prior))
    for last in range(ROUNDS + 1):
        weights = prior + learnt
        logs = np.log(np.where(weights > 0, weights, 1) / (weights.sum() + c[None] + PRIOR))
        learnt = expected(logs, {w.decode(): n for w, n in c.items() if w is not None}) if last < ROUNDS else learnt
    end = math.log10((c[None] + PRIOR) / (weights.sum() + c[None] + PRIOR))
    of = {w: math.log10(total(logs, "▁" + w.decode())) for _, t in rows for w in words(t or "") if len(w) < 100}
    scores = sorted(sum(of[w] for w in words(t or "")) + end for _, t in rows if all(w in of for w in words(t or "")))
    assert sorted(r.score for r in got if r.score > -5000) == pytest.approx(scores, rel=1e-6)  # expected counts are whole units
    return got


def test_scores(spark, monkeypatch):
    monkeypatch.setattr(lattice_lm, "WORDS", 100)
    rng = random.Random(1)
    rows = [(i * 7, " ".join(rng.choices(["The", "of", "straße", "nation", "rare%d" % i], [5, 4, 2, 2, 1], k=rng.randint(0, 50)))) for i in range(900)]
    rows += [(1, None), (2, ""), (next(i for i in range(1, 100) if held(i) and i % 7), "x" * 20_000), (7, rows[1][1]), (7, rows[1][1])]
    got = run(spark, rows)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_edges(spark):
    assert score(spark.createDataFrame([], SCHEMA), PATH).collect() == []
    run(spark, [(next(i for i in range(100) if held(i)), "a b")])
    run(spark, [(None, "a b"), (None, None), (4, "b")])
