import hashlib
import re

import numpy as np
import pytest
import xxhash

from signalloom.llm import multiset_hash
from signalloom.llm.multiset_hash import edited_fingerprints, fingerprints

SCHEMA = "doc_id long, text string, n_chars long, part long"


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def edited(rows):
    """Brute force: id, length, edited text and next text of each row."""
    rows = sorted(rows, key=lambda r: (-r[0] if r[0] is not None else float("inf"), signed(xxhash.xxh64_intdigest((r[1] or "").encode(), 42))))
    out = []
    for i, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        out.append((doc_id, text, text[: len(text) - half] + after[:half], after))
    return out


def vector(text):
    """Brute force: pieces, check lanes and one-bit lanes of a text."""
    pieces = [p for p in re.split(r"(?<=[.!?\n])(?![.!?\n])", text) if p]
    hashes = [[xxhash.xxh64_intdigest(i.to_bytes(4, "little"), xxhash.xxh64_intdigest(p.encode(), 42)) for i in range(3)] for p in pieces]
    h = np.array(hashes, np.uint64).reshape(-1, 3)
    checks = [int((x >> np.uint64(32 * half) & np.uint64(0xFFFFFFFF)).sum()) % 2**32 for x in h.T for half in (0, 1)]
    lanes = [2 * int((x >> np.uint64(k + 31 * j) & np.uint64(1)).sum()) - len(h) for x in h.T for k in range(31) for j in (0, 1)]
    return len(h), checks, lanes


def alike(a, b):
    (n, _, x), (m, _, y) = a, b
    x, y = np.array(x, float), np.array(y, float)
    norms = x @ x + y @ y
    return min(1.0, max(0.0, 2 * (x @ y) / norms)) if norms else float(n == m)


def run(spark, rows):
    got = edited_fingerprints(spark.createDataFrame([(*r, 7, 8) for r in rows], SCHEMA)).collect()
    want = []
    for doc_id, text, made, after in edited(rows):
        a, b, c = vector(text), vector(made), vector(after)
        as_hex = lambda v: "".join(f"{x:08x}" for x in v[1])
        want.append((-1 if doc_id is None else doc_id, len(text), hashlib.sha256(made.encode()).hexdigest(), as_hex(a), as_hex(b), round(alike(a, b), 9), round(alike(a, c), 9), a[0], a[2], b[0], b[2]))
    found = [(-1 if r[0] is None else r[0], *r[1:5], round(r.near_edited, 9), round(r.near_next, 9), r.n_pieces, r.sketch, r.edited_n_pieces, r.edited_sketch) for r in got]
    assert sorted(found) == sorted(want)
    return got


def test_edits_follow_descending_ids_over_gaps_and_ranges(spark):
    rows = [(i * i * 37, f"Line {i}. Ünï {i % 5}!\nMore of {i}. " * (i % 4)) for i in range(150)]
    rows += [(10**12, "far away. "), (-5, "below"), (3, None), (3, "x"), (3, "x"), (4, ""), (None, "no id"), (None, None)]
    for r in run(spark, rows):
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


def test_hot_ids_are_split(spark, monkeypatch):
    monkeypatch.setattr(multiset_hash, "HOT", 4)
    rows = [(None, f"none {i}. more") for i in range(60)] + [(64 * 5 + 3, f"one {i}. more") for i in range(60)] + [(i * 3, f"row {i}. more") for i in range(200)]
    run(spark, rows)
    monkeypatch.setattr(multiset_hash, "FEW", 0)  # too many split ranges to send to all
    run(spark, rows)


def test_texts_of_over_two_million_pieces(spark):
    rows = [(1, "".join(f"a{i}\n" for i in range(2_200_000))), (2, "".join(f"b{i}\n" for i in range(2_200_000)))]
    got = edited_fingerprints(spark.createDataFrame([(*r, 7, 8) for r in rows], SCHEMA)).collect()
    a, b = vector(rows[0][1]), vector(rows[1][1])
    assert [r.sketch for r in sorted(got)] == [a[2], b[2]]
    assert all(r.near_next == pytest.approx(alike(a, b), abs=1e-9) and r.near_next < 0.4 for r in got)


def test_one_row_and_no_rows(spark):
    (r,) = run(spark, [(1, "Same. Same. Other.")])
    assert r.near_next == 1
    assert run(spark, []) == []


def test_equal_and_reordered_texts_have_equal_fingerprints_and_others_do_not(spark):
    long = "".join(f"Sentence number {i}.\n" for i in range(300_0))
    rows = [(1, "A b.\nC d.\n"), (2, "C d.\nA b.\n"), (3, "A b.\nC e.\n"), (4, None), (5, ""), (6, long), (7, "." * 100_000)]
    got = {r.doc_id: r for r in fingerprints(spark.createDataFrame([(*r, 1, 1) for r in rows], SCHEMA)).collect()}
    assert got[1].fingerprint == got[2].fingerprint != got[3].fingerprint
    assert got[4].fingerprint == got[5].fingerprint == "0" * 48
    assert got[6].n == 3000 and got[7].n == 1


def test_adding_a_piece_adds_its_vector(spark):
    rows = [(1, "A b.\nC d.\n"), (2, "A b.\n"), (3, "C d.\n")]
    got = {r.doc_id: r for r in fingerprints(spark.createDataFrame([(*r, 1, 1) for r in rows], SCHEMA)).collect()}
    assert [(a + b) % 2**32 for a, b in zip(got[2].checks, got[3].checks)] == got[1].checks
    assert [a + b for a, b in zip(got[2].sketch, got[3].sketch)] == got[1].sketch


def test_likeness_follows_shared_sentences(spark):
    texts = ["".join(f"Doc {d} says {i}. " for i in range(60)) for d in range(40)]
    got = run(spark, list(enumerate(texts)))
    assert all(0.25 < r.near_edited < 0.75 for r in got)
    assert all(r.near_next < 0.3 for r in got)


def test_next_tops_of_ids_far_apart(spark, monkeypatch):
    """Against sorting, with levels that are used; windows without a partition see a few ranges alone."""
    rng = np.random.default_rng(8)
    ids = sorted({int(x) for x in rng.integers(-(1 << 45), 1 << 45, 3000)} | {-(1 << 50), 0, 1, 2, 70_000, 1 << 40})
    for fan in (1 << 16, 1 << 12):
        monkeypatch.setattr(multiset_hash, "FAN", fan)
        df = spark.createDataFrame([(i, f"t{i}") for i in ids], "at long, top string")
        got = {r["at"]: r.next_top for r in multiset_hash.next_tops(df, "at", 2).collect()}
        assert got == {i: f"t{ids[k - 1]}" for k, i in enumerate(ids)}
    assert len({i >> 32 for i in ids}) > 1000 and max(abs(i >> 32) for i in ids if i > -(1 << 50)) <= 1 << 13
    assert [r.next_top for r in multiset_hash.next_tops(spark.createDataFrame([(5, "a")], "at long, top string"), "at", 2).collect()] == ["a"]


def test_hashed_ids(spark):
    rng = np.random.default_rng(9)
    run(spark, [(int(i), f"Text {k}. More {k}.\n") for k, i in enumerate(rng.integers(-(1 << 62), 1 << 62, 400))])
