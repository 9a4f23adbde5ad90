import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from signalloom.llm.prefix_bpe import PrefixEncoder, decode, encode, encoded, read_ranks, round_trip
from signalloom.llm.token_counts import MergeCounter, count_tokens

JSON, RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
SCHEMA = "doc_id long, text string, n_tokens long, ids string"


def texts(n):
    rng = random.Random(1)
    pick = [lambda: chr(rng.randint(1, 0x2FFF)), lambda: rng.choice("  \n\t\x0b\x1c\x85\xa0"), lambda: rng.choice("abcdefg'st12 "), lambda: chr(rng.randint(0x1F000, 0x1FFFF)), lambda: chr(rng.randint(0x3000, 0xD7FF))]
    out = ["".join(rng.choice(pick)() for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return [*out, "", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endof", "a" * 5000, " " * 3000, "ab" * 999, "it's we'll"]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})


def test_counts_equal_the_librarys():
    counter, t = MergeCounter(JSON), Tokenizer.from_file(JSON)
    for text in texts(3000):
        assert counter.count(text) == len(t.encode(text, add_special_tokens=False).ids), repr(text)


def test_count_rows(spark):
    rows = [(1, "Hello world"), (1, "Hello world"), (2, None), (3, ""), (None, "é"), (4, "word " * 100_000)]
    got = count_tokens(spark.createDataFrame([(*r, 9, "x") for r in rows], SCHEMA), JSON).collect()
    assert [(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got[:5]] == [(1, 11, 2, False), (1, 11, 2, False), (2, 0, 0, False), (3, 0, 0, False), (None, 2, got[4].n_tokens, False)]
    assert got[5].n_bytes == 500_000 and got[5].over_limit
    assert count_tokens(spark.createDataFrame([], SCHEMA), JSON).collect() == []


def test_ids_equal_the_librarys(library):
    e = PrefixEncoder(RANKS, PATTERN)
    for text in texts(3000):
        ids = library.encode_ordinary(text)
        assert e.encode(text) == ",".join(map(str, ids)), repr(text)
        assert e.decode(ids) == text.encode()


def test_appends_and_edits_equal_encoding_anew():
    e, rng = PrefixEncoder(RANKS, PATTERN), random.Random(2)
    for _ in range(200):
        piece = bytes(rng.choices(b"abcdefghi thnd", k=rng.randint(1, 400)))
        at = rng.randint(0, len(piece))
        last = e.extend(piece, e.extend(piece[:at], []))
        assert last == e.extend(piece, [])
        removed, added = rng.randint(0, min(5, len(piece) - at)), bytes(rng.choices(b"abc th", k=rng.randint(0, 4)))
        new, now = e.edit(piece, last, at, removed, added)
        assert new == piece[:at] + added + piece[at + removed :] and now == e.extend(new, [])


def test_round_trip_rows(spark, library):
    rows = [(1, "Hello wörld"), (1, "Hello wörld"), (2, None), (3, ""), (None, "é"), (4, "word " * 30_000)]
    df = spark.createDataFrame([(*r, 9, "x") for r in rows], SCHEMA)
    for r, (doc_id, text) in zip(round_trip(df, RANKS, PATTERN).collect(), rows):
        ids = library.encode_ordinary(text or "")
        said = ",".join(map(str, ids))
        assert (r.doc_id, r.n_tokens) == (doc_id, len(ids))
        assert r.ids_sha256 == hashlib.sha256(said.encode()).hexdigest() and r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    back = df.select("text", decode(encode(df.text, RANKS, PATTERN), RANKS, PATTERN).cast("string").alias("back")).collect()
    assert all(r.back == (r.text or "") for r in back)
    assert round_trip(df.limit(0), RANKS, PATTERN).collect() == []
    plain = df.select("doc_id", "text")
    assert [r.ids for r in encoded(plain, RANKS, PATTERN).collect()] == [library.encode_ordinary(t or "") for _, t in rows]


def test_pieces_of_few_texts_are_held_at_once(library, monkeypatch):
    encoder, seen, cut = PrefixEncoder(RANKS, PATTERN, remembered=50), [], PrefixEncoder.encode_some
    monkeypatch.setattr("signalloom.llm.prefix_bpe.AT_ONCE", 1000)
    monkeypatch.setattr(PrefixEncoder, "encode_some", lambda self, of: seen.append(of) or cut(self, of))
    many = texts(500)
    assert [*encoder.encode_all(many)] == [",".join(map(str, library.encode_ordinary(t))) for t in many]
    assert sum(seen, []) == many and max(sum(map(len, of)) for of in seen if len(of) > 1) <= 1000 and len(seen) < len(many) / 5
    assert [*encoder.encode_all([])] == []


def test_pieces_encoded_together_equal_those_one_by_one(library, monkeypatch):
    encoder, rng = PrefixEncoder(RANKS, PATTERN), random.Random(4)
    alphabets = ["ab", "the ing", "aä€😀", "".join(map(chr, range(1, 600)))]
    pieces = sorted({"".join(rng.choices(rng.choice(alphabets), k=rng.randint(1, 30))).encode() for _ in range(3000)})
    pieces += [p[:-1] for p in pieces[:50] if len(p) > 1]
    pieces = sorted(set(pieces))
    last = encoder.extend_all(pieces)
    assert [last[: len(p), i].tolist() for i, p in enumerate(pieces)] == [encoder.extend(p, []) for p in pieces]
    assert [*encoder.walk_all(pieces, last)] == [encoder.walk(p, encoder.extend(p, [])) for p in pieces]
    monkeypatch.setattr("signalloom.llm.prefix_bpe.ROWS", 7)
    for text in texts(300):
        assert encoder.encode(text) == ",".join(map(str, library.encode_ordinary(text)))
    monkeypatch.setattr(PrefixEncoder, "extend", None)  # pieces that aren't long don't go one by one
    assert encoder.encode(" unheardofwords zyxwvut") == ",".join(map(str, library.encode_ordinary(" unheardofwords zyxwvut")))
