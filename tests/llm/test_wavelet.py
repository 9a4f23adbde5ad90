import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
from tokenizers import Tokenizer

from signalloom.llm import wavelet
from signalloom.llm.wavelet import PieceEncoder, WaveletMatrix, build, encode_and_read_back, occurrences, write_shards

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, shard long, file string"


def test_matrix_answers_like_the_list():
    rng = np.random.default_rng(1)
    for n in (0, 1, 511, 512, 513, 3000, 300_000):
        ids = (rng.integers(0, 20, n) * 2500).astype(np.uint32)
        m = WaveletMatrix(build(ids, [7, None], np.array([n // 2, n - n // 2])))
        assert m.documents()[0] == [7, None] and m.documents()[1].sum() == n
        for i in rng.integers(0, n, 10) if n else []:
            before = (ids[:i] == ids[i]).sum()
            assert m.access([i])[0] == ids[i] and m.rank(ids[i], [i])[0] == before and m.select(ids[i], before) == i
        if n > 100_000:
            assert not m.loaded.all()  # only what was asked for has been unpacked
        assert (m.access(np.arange(n)) == ids).all()
        places = np.sort(rng.integers(0, n + 1, 50))
        for token in (0, 2500, 7):
            assert (m.rank(token, places) == [(ids[:p] == token).sum() for p in places]).all()
        assert m.rank(7, [n])[0] == 0 and m.select(7, 0) == -1 and m.rank(1 << 20, [n])[0] == 0


def encoded(of, texts):
    ids, sizes = of.encode(pa.array(texts, pa.string()))
    return [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]


def test_pieces_encode_like_whole_texts(monkeypatch):
    rng, t, c = random.Random(2), Tokenizer.from_file(PATH), PieceEncoder(PATH)
    letters = [*"abcDE's.,'t12 \n\t  é́ßÀ×÷<|", " ", "\u0085", "　", "\x1c", "中", "🙂", "<|endoftext|>", "<|startoftext|>", "İ", "n't"]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(4000)] + ["", " ", "a" * 3000]
    want = [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    assert c.cuts and encoded(c, texts) == want
    assert encoded(c, texts) == want  # now remembered
    monkeypatch.setattr(wavelet, "WINDOW", 64)
    assert encoded(PieceEncoder(PATH), texts) == want
    monkeypatch.setattr(wavelet, "PIECES", 10)
    assert encoded(PieceEncoder(PATH), texts[:300]) == want[:300]


def test_another_vocabulary_is_used_on_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    t, c, texts = Tokenizer.from_file(path), PieceEncoder(path), ["It's  one\n text", "", "é 12<|endoftext|>"]
    assert not c.cuts and encoded(c, texts) == [t.encode(x, add_special_tokens=False).ids for x in texts]


def brute(rows):
    t, at, out = Tokenizer.from_file(PATH), 0, []
    h = lambda text: np.uint64(xxhash.xxh64_intdigest((text or "").encode(), 42)).view(np.int64)
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, h(r[1]))):
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids.count(1)))
        at += len(ids)
    return out


def test_documents_read_back(spark):
    rng = random.Random(3)
    rows = [(rng.randint(-10**6, 10**6) * 3, " ".join(rng.choices(["one", "Two,", "thrée", '12.5"'], k=rng.randint(0, 30))), 1, "x") for _ in range(300)]
    rows += [(10**9, None, 2, None), (None, "no id", 1, None), (None, None, 1, None), rows[0], rows[0], (5, "word " * 30_000, 1, "")]
    rows += [(None, f"none {i}", 1, None) for i in range(200)] + [(77, f"again {i}", 1, None) for i in range(200)]  # hot ids
    df = spark.createDataFrame(rows, SCHEMA)
    key = lambda r: (r[1], r[0] is not None, r[0] or 0)
    assert sorted((tuple(r) for r in encode_and_read_back(df, PATH).collect()), key=key) == sorted(brute(rows), key=key)
    assert encode_and_read_back(df.limit(0), PATH).collect() == []
    shards = write_shards(df, PATH, 1)
    assert sum(r.n for r in occurrences(shards, 1).collect()) == sum(r[4] for r in brute(rows))
