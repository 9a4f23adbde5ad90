"""Token ids in wavelet matrices: one compressed file per shard, from which documents, tokens, counts and places are read.

A wavelet matrix keeps a sequence as one plane of bits per bit of an id's number in the shard's alphabet, from the highest;
behind each plane, the elements with a 0 come before those with a 1. Running counts of ones per block of bits give rank, which leads
from a place in one plane to its place in the next: so a token at any place (access), how often an id occurs before a place
(rank) and where it occurs for the k-th time (select, by bisection) are answered from the planes alone.

A file holds its own directory (the shard's documents and their lengths) and alphabet; planes lie in chunks that are
compressed each on its own, so that what is asked for decides what is unpacked. Python is needed since Spark has no operators on packed bits.
"""

from __future__ import annotations

import json
import os
import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalloom.llm.common import Remembered, keep, one_model

#: Tokens that fill a shard; a document isn't split.
SHARD = 1 << 18
#: Bits between running counts, and bits of a plane that are compressed together.
BLOCK, CHUNK = 512, 1 << 17
HEADER, MAGIC = "<4sQIIQI", b"WVM2"
#: Distinct pieces whose ids a worker remembers, and as many of those before.
PIECES = 400_000
#: Bytes of text that are cut into pieces at once.
WINDOW = 4 << 20


def packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values))


def unpacked(raw: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), kind)


def build(ids: np.ndarray, doc_ids: list[int | None], lengths: np.ndarray) -> bytes:
    """The file of a sequence of ids and of the documents that it is made of."""
    used = np.zeros(int(ids.max()) + 1 if len(ids) else 1, bool)
    used[ids] = True
    alphabet = np.flatnonzero(used)
    levels = max(1, (len(alphabet) - 1).bit_length())
    now = (np.cumsum(used) - 1).astype(np.uint16 if levels <= 16 else np.uint32)[ids]
    known = np.array([d is not None for d in doc_ids], bool)
    sections = [packed(alphabet.astype("<u4")), packed(np.array([d or 0 for d in doc_ids], "<i8")), packed(known), packed(lengths.astype("<u8"))]
    n = len(ids)
    for b in range(levels - 1, -1, -1):
        one = (now & now.dtype.type(1 << b)).astype(bool)
        plane = np.zeros(-(-n // BLOCK) * (BLOCK // 8), np.uint8)
        bits = np.packbits(one, bitorder="little")
        plane[: len(bits)] = bits
        counts = np.bitwise_count(plane.view(np.uint64)).reshape(-1, BLOCK // 64).sum(axis=1)
        sections.append(packed(counts.astype("<u2")))
        sections += [packed(plane[at : at + CHUNK // 8]) for at in range(0, len(plane), CHUNK // 8)]
        after, zeros = np.empty_like(now), n - int(counts.sum())
        np.compress(~one, now, out=after[:zeros])
        np.compress(one, now, out=after[zeros:])
        now = after
    ends = np.cumsum([0, *map(len, sections)]).astype("<u8")
    return b"".join([struct.pack(HEADER, MAGIC, n, levels, BLOCK, CHUNK, len(sections)), ends.tobytes(), *sections])


class WaveletMatrix:
    def __init__(self, raw: bytes):
        magic, self.n, self.levels, block, chunk, sections = struct.unpack_from(HEADER, raw)
        if magic != MAGIC or block != BLOCK or chunk != CHUNK:
            raise ValueError("not a wavelet matrix of this format")
        at = struct.calcsize(HEADER)
        ends = np.frombuffer(raw, "<u8", sections + 1, at) + at + 8 * (sections + 1)
        self.section = lambda i: raw[ends[i] : ends[i + 1]]
        self.alphabet = unpacked(self.section(0), "<u4")
        self.chunks = -(-self.n // CHUNK)
        self.counts = [np.concatenate([[0], np.cumsum(unpacked(self.section(4 + level * (1 + self.chunks)), "<u2"), dtype=np.int64)]) for level in range(self.levels)]
        self.zeros = [self.n - int(c[-1]) for c in self.counts]
        self.planes: list[np.ndarray | None] = [None] * self.levels
        self.loaded = np.zeros((self.levels, self.chunks), bool)

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        """Ids of the shard's documents, in order, and how many tokens each has."""
        ids, known, lengths = (unpacked(self.section(i), k) for i, k in ((1, "<i8"), (2, "?"), (3, "<u8")))
        return [d if k else None for d, k in zip(ids.tolist(), known.tolist())], lengths.astype(np.int64)

    def _plane(self, level: int, places: np.ndarray | None = None) -> np.ndarray:
        """A plane's bytes, of which all chunks, or those of some places, are unpacked."""
        if self.planes[level] is None:
            self.planes[level] = np.zeros(-(-self.n // BLOCK) * (BLOCK // 8), np.uint8)
        plane, loaded = self.planes[level], self.loaded[level]
        wanted = ~loaded if places is None else np.zeros(self.chunks, bool)
        if places is not None:
            wanted[places // CHUNK] = True
            wanted &= ~loaded
        for c in np.flatnonzero(wanted):
            part = unpacked(self.section(4 + level * (1 + self.chunks) + 1 + c), "u1")
            plane[c * CHUNK // 8 : c * CHUNK // 8 + len(part)] = part
        loaded |= wanted
        return plane

    def _ones(self, level: int, places: np.ndarray) -> np.ndarray:
        """How many ones of a plane are before places (0 to n): running counts, and what is left of the block."""
        inside = np.minimum(places, self.n - 1)
        words = self._plane(level, inside).view("<u8")
        ones, block = self.counts[level][places // BLOCK], places // BLOCK * (BLOCK // 64)
        for k in range(BLOCK // 64):
            at = block + k
            ones = ones + np.where(at < places // 64, np.bitwise_count(words[np.minimum(at, len(words) - 1)]), 0)
        rest = words[inside // 64] & ((np.uint64(1) << (places % 64).astype(np.uint64)) - np.uint64(1))
        return ones + np.where(places // 64 == inside // 64, np.bitwise_count(rest), 0)

    def _step(self, level: int, places: np.ndarray) -> np.ndarray:
        """Where the elements at places of a plane are in the next: a one goes behind all zeros; each keeps its rank among its like."""
        if 8 * len(places) < self.n:
            one = self._plane(level, places)[places // 8] >> (places % 8).astype(np.uint8) & 1
            ones = self._ones(level, places)
            return np.where(one.view(bool), self.zeros[level] + ones, places - ones)
        bits = np.unpackbits(self._plane(level), count=self.n, bitorder="little")  # for so many places, count the plane through once
        ones = np.cumsum(bits, dtype=places.dtype)
        after = np.arange(self.n, dtype=places.dtype)
        after -= ones
        ones += places.dtype.type(self.zeros[level] - 1)
        np.copyto(after, ones, where=bits.view(bool))
        return after.take(places)

    def access(self, places) -> np.ndarray:
        """The ids at places."""
        at = np.asarray(places, np.int32 if self.n < 1 << 30 and 8 * len(places) >= self.n else np.int64)
        code = np.zeros(len(at), np.uint16 if self.levels <= 16 else np.uint32)
        for level in range(self.levels if len(at) else 0):
            at = self._step(level, at)
            code <<= 1
            code |= at >= self.zeros[level]
        return self.alphabet[code] if len(at) else code.astype(np.uint32)

    def code(self, token: int) -> int:
        """The id's number in the alphabet; -1 if the shard doesn't have it."""
        at = int(np.searchsorted(self.alphabet, token))
        return at if at < len(self.alphabet) and self.alphabet[at] == token else -1

    def rank(self, token: int, places) -> np.ndarray:
        """How often the id occurs before places (0 to n)."""
        code, hi = self.code(token), np.asarray(places, np.int64)
        if code < 0 or not self.n:
            return np.zeros(len(hi), np.int64)
        lo = np.zeros(1, np.int64)
        for level in range(self.levels):
            a, b = self._ones(level, lo), self._ones(level, hi)
            lo, hi = (self.zeros[level] + a, self.zeros[level] + b) if code >> (self.levels - 1 - level) & 1 else (lo - a, hi - b)
        return hi - lo

    def select(self, token: int, k: int) -> int:
        """The place where the id occurs for the k-th time (from 0); -1 if it occurs less often."""
        if not 0 <= k < self.rank(token, [self.n])[0]:
            return -1
        lo, hi = 0, self.n - 1
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if self.rank(token, [mid + 1])[0] > k else (mid + 1, hi)
        return lo


#: How the vocabulary's file cuts texts, on which the cuts made here rest (fixed values of the format).
NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Kinds of bytes: what isn't known here, blanks, letters (of two bytes from À to ÿ, whose second bytes stand behind 0xC3 alone), digits, marks.
ODD, BLANK, LETTER, DIGIT, MARK = range(5)


def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """The kind of each byte, and what it is in lower case."""
    kind, lower = np.zeros(256, np.uint8), np.arange(256, dtype=np.uint8)
    for b in range(256):
        c = chr(b)
        if c in " \t\n\r":
            kind[b] = BLANK
        elif c.isascii() and c.isalpha() or b == 0xC3 or 0x80 <= b < 0xC0 and b not in (0x97, 0xB7):  # × and ÷ are no letters
            kind[b] = LETTER
        elif c.isascii() and c.isdigit():
            kind[b] = DIGIT
        elif "!" <= c <= "~" and c not in "'<":  # special tokens begin with <, and ' may go with the letters behind it
            kind[b] = MARK
        if "A" <= c <= "Z" or 0x80 <= b <= 0x9E and b != 0x97:
            lower[b] = b + 32
    return kind, lower


KIND, LOWER = _kinds()
PLAIN = bytes(np.flatnonzero(KIND >= LETTER).astype(np.uint8))


class PieceEncoder(Remembered):
    """Piece of a text (bytes) -> its ids as little-endian bytes.

    White space is dropped and never looked across, nor do special tokens hold any, so a text is cut at blanks. Chunks of
    plain letters, digits and marks alone are cut where the vocabulary's pattern cuts them, and are put into lower case; others stay
    whole. Pieces that are new go to the tokenizer a batch at a time. A file that cuts in another way is used on whole texts.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__(PIECES)
        self.tokenizer = Tokenizer.from_file(path)
        # the same vocabulary for plain pieces, which are in lower case and cut already
        self.for_plain = Tokenizer.from_file(path)
        self.for_plain.normalizer = None
        self.for_plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocabulary, suffix = self.tokenizer.get_vocab(), spec["model"].get("end_of_word_suffix")
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        known = steps[0].get("pattern") == {"Regex": SPLIT} and steps[0].get("behavior") == "Removed" and steps[0].get("invert") and [s["type"] for s in steps[1:]] == ["ByteLevel"] and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"]
        specials = [t["content"] for t in spec["added_tokens"]]
        self.cuts = bool(known and suffix) and (spec.get("normalizer") or {}).get("normalizers") == NORMALIZER and all(t.startswith("<") and not any(c.isspace() for c in t) for t in specials)

    def look_up(self, pieces: list[bytes]) -> list[bytes]:
        got = list(map(self.get, pieces))
        missing = [i for i, ids in enumerate(got) if ids is None]
        new = []
        for i in missing:
            got[i] = self.older.get(pieces[i])
            if got[i] is None:
                new.append(i)
        for i, ids in zip(new, self.learn([pieces[i] for i in new])):
            got[i] = ids
        self.make_room(len(missing))
        self.update((pieces[i], got[i]) for i in missing if len(pieces[i]) <= self.longest)
        return got

    def learn(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of pieces, by the tokenizer: plain ones many at a time, between blanks, as each ends with its only token that ends a word."""
        out: list[bytes] = [b""] * len(pieces)
        plain = [i for i, p in enumerate(pieces) if not p.translate(None, PLAIN)]
        other = [i for i, p in enumerate(pieces) if p.translate(None, PLAIN)]
        texts = [b" ".join([pieces[i] for i in plain[at : at + 256]]).decode() for at in range(0, len(plain), 256)]
        for at, found in zip(range(0, len(plain), 256), self.for_plain.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            ends, raw, begin = (4 * np.flatnonzero(self.ends_word[ids]) + 4).tolist(), ids.tobytes(), 0
            for i, end in zip(plain[at : at + 256], ends, strict=True):
                out[i], begin = raw[begin:end], end
        for i, found in zip(other, self.tokenizer.encode_batch_fast([pieces[i].decode(errors="replace") for i in other], add_special_tokens=False)):
            out[i] = np.array(found.ids, "<u4").tobytes()
        return out

    def pieces(self, data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, pa.Array]:
        """Where the pieces of some bytes of texts start, and the pieces. first: which bytes are a text's first."""
        kind = KIND[data]
        before = np.concatenate([[BLANK], kind[:-1]])
        before[first] = BLANK
        solid, values = kind != BLANK, LOWER[data]
        new = solid & ((kind != before) | (kind == DIGIT))
        if (kind == ODD).any():
            chunk_starts = solid & (before == BLANK)
            chunk = np.cumsum(chunk_starts)
            odd = np.zeros(chunk[-1] + 1, bool)
            odd[chunk[kind == ODD]] = True
            odd = odd[chunk] & solid
            new, values = np.where(odd, chunk_starts, new), np.where(odd, data, values)
        at, upto = np.flatnonzero(new), np.cumsum(solid, dtype=np.int32)
        offsets = np.append(upto[at] - 1, upto[-1] if len(upto) else 0).astype(np.int32)
        return at, pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values[solid]))])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (strings, none null), and how many each has."""
        if not self.cuts:
            each = [np.array(found.ids, np.uint32) for found in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            return np.concatenate([np.zeros(0, np.uint32), *each]), np.array(list(map(len, each)), np.int64)
        texts = texts.cast(pa.large_binary())
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        ids, starts, sizes, lo = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        while lo < len(data):
            hi = min(lo + WINDOW, len(data))
            while hi < len(data) and KIND[data[hi]] != BLANK:  # a chunk isn't cut
                blanks = np.flatnonzero(KIND[data[hi : hi + WINDOW]] == BLANK)
                hi = hi + int(blanks[0]) if len(blanks) else min(hi + WINDOW, len(data))
            first = bounds[(bounds >= lo) & (bounds < hi)] - lo
            at, found = self.pieces(data[lo:hi], first)
            coded = found.dictionary_encode()
            each = self.look_up(coded.dictionary.to_pylist())
            offsets = np.cumsum([0, *map(len, each)], dtype=np.int64) // 4
            of_pieces = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(each), "<u4"))).take(coded.indices)
            ids.append(of_pieces.flatten().to_numpy())
            size_at = np.diff(of_pieces.offsets.to_numpy())
            starts.append(at + lo)
            sizes.append(size_at)
            lo = hi
        starts, upto = np.concatenate(starts), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        return np.concatenate(ids), np.diff(upto[np.searchsorted(starts, bounds)])


def encoder(path: str) -> PieceEncoder:
    return one_model(PieceEncoder, path)


def filled_shards(batches, of: PieceEncoder, end_id: int, part: int):
    """Batches of documents (doc_id, text) as rows of shards (part, seq, n_tokens, file)."""
    ids, doc_ids, lengths, held, seq = [], [], [], 0, 0

    def row():
        file = build(np.concatenate(ids), doc_ids, np.array(lengths, np.int64))
        return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "n_tokens": pa.array([held], pa.int64()), "file": pa.array([file], pa.binary())})

    for batch in batches:
        got, sizes = of.encode(batch.column("text"))
        got = np.insert(got, np.cumsum(sizes), end_id)
        at = 0
        for doc_id, size in zip(batch.column("doc_id").to_pylist(), (sizes + 1).tolist()):
            if held and held + size > SHARD:
                yield row()
                ids, doc_ids, lengths, held, seq = [], [], [], 0, seq + 1
            ids.append(got[at : at + size])
            doc_ids.append(doc_id)
            lengths.append(size)
            held, at = held + size, at + size
    if held:
        yield row()


def listed(batches, end_id: int):
    """Batches of shards (part, seq, file) as rows of documents (part, seq, doc_id, inside, n_tokens, ids_crc32, n_end_ids)."""
    names, types = ["part", "seq", "doc_id", "inside", "n_tokens", "ids_crc32", "n_end_ids"], [pa.int32()] * 2 + [pa.int64()] * 5
    for batch in batches:
        for part, seq, file in zip(*(batch.column(c).to_pylist() for c in ("part", "seq", "file"))):
            matrix = WaveletMatrix(file)
            doc_ids, sizes = matrix.documents()
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            tokens = matrix.access(np.arange(matrix.n)).astype("<u4", copy=False)
            crc = [zlib.crc32(tokens[a:b]) for a, b in zip(bounds.tolist(), bounds[1:].tolist())]
            columns = [np.full(len(doc_ids), part), np.full(len(doc_ids), seq), doc_ids, bounds[:-1], sizes, crc, np.diff(matrix.rank(end_id, bounds))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def write_shards(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode the texts and write one row per shard, in the shared folder: part, seq (which order shards), n_tokens, file.

    Documents are dealt by ranges of ascending id, null ids first and rows of one id by a hash of the text, so that no range need hold all rows of an id. Null texts
    are empty; each text's ids end with end_id.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"))
    order = [F.asc_nulls_first("doc_id"), "h"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text").select("doc_id", "text")

    def shards(batches):
        yield from filled_shards(batches, encoder(path), end_id, TaskContext.get().partitionId())

    return keep(rows.mapInArrow(shards, "part int, seq int, n_tokens long, file binary"), "wavelet")


def starts(shards: DataFrame) -> DataFrame:
    """part, seq and how many ids the shards before hold (first), summed over parts and then within each."""
    before = lambda w: F.coalesce(F.sum("n_tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
    sizes = shards.select("part", "seq", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens")).select("part", before(Window.orderBy("part")).alias("outside"))
    inside = sizes.select("part", "seq", before(Window.partitionBy("part").orderBy("seq")).alias("inside"))
    return inside.join(parts, "part").select("part", "seq", (F.col("inside") + F.col("outside")).alias("first"))


def read_documents(shards: DataFrame, end_id: int = 1) -> DataFrame:
    """A row per document, read from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit integers), n_end_ids (how often end_id is among them, by rank)."""

    def documents(batches):
        yield from listed(batches, end_id)

    rows = shards.select("part", "seq", "file").mapInArrow(documents, "part int, seq int, doc_id long, inside long, n_tokens long, ids_crc32 long, n_end_ids long")
    return rows.join(starts(shards), ["part", "seq"]).select("doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", "n_end_ids")


def occurrences(shards: DataFrame, token: int) -> DataFrame:
    """Per shard (part, seq) how often an id occurs and where first (place in the shard, -1 if nowhere), from rank and select alone."""

    def looked_up(batches):
        for batch in batches:
            rows = []
            for part, seq, file in zip(*(batch.column(c).to_pylist() for c in ("part", "seq", "file"))):
                matrix = WaveletMatrix(file)
                rows.append({"part": part, "seq": seq, "n": int(matrix.rank(token, [matrix.n])[0]), "first": matrix.select(token, 0)})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n", pa.int64()), ("first", pa.int64())]))

    return shards.select("part", "seq", "file").mapInArrow(looked_up, "part int, seq int, n long, first long")


def encode_and_read_back(docs: DataFrame, path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write all texts' ids to wavelet-matrix files in ascending doc_id order and list the documents from these files.

    One row per input row, repeated rows included: doc_id, start, n_tokens (with the end id), ids_crc32, n_end_ids. A null text is an
    empty one, which has the end id alone; null ids come first, rows of one id by a hash of the text. Texts of any length are encoded whole. An empty table gives
    an empty result; other columns are ignored.
    """
    return read_documents(write_shards(docs, path, end_id, id_col, text_col), end_id)
