"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For every prefix of a piece there is exactly one token that can end its encoding: the one that fits after the last
token of the shorter prefix it leaves. Storing that token per prefix gives the encoding by walking back, lets a text
grow without encoding it anew, and after an edit needs new work only until the stored tokens agree again.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalloom.llm.common import Remembered, one_model

#: Distinct pieces whose ids a worker remembers, and as many of those before; token pairs whose fit it remembers.
REMEMBERED, FITS = 200_000, 150_000
#: Characters of texts, or one longer text, that are cut into pieces at once.
AT_ONCE = 1 << 20
#: New pieces of up to LONG bytes are encoded together, up to ROWS of them; longer ones one by one.
LONG, ROWS = 32, 1 << 14
#: Slots of a look-up table, as a power of two.
SLOT_BITS = 21


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Lookup:
    """Values (from 0) of many keys (whole numbers, all different) at once; -1 for others."""

    def __init__(self, of: dict[int, int]):
        self.keys, self.values = np.array([*of], np.int64), np.array([*of.values()], np.int64)
        order = np.argsort(self.keys)
        self.keys, self.values = self.keys[order], self.values[order]
        self.slots = np.full(1 << SLOT_BITS, -1, np.int32)
        self.slots[self.slot(self.keys)] = np.arange(len(order))

    @staticmethod
    def slot(keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - SLOT_BITS)).view(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self.slots[self.slot(keys)]
        some = np.flatnonzero(at >= 0)
        out, at, wanted = np.full(len(keys), -1, np.int64), at[some], keys[some]
        out[some] = np.where(same := self.keys[at] == wanted, self.values[at], -1)
        if not same.all():  # the slot is another key's
            some, wanted = some[~same], wanted[~same]
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            out[some] = np.where(self.keys[at] == wanted, self.values[at], -1)
        return out


class PrefixEncoder(Remembered):
    """Piece -> ids as decimal text joined by commas, worked out when first asked for."""

    def __init__(self, path: str, pattern: str, remembered: int = REMEMBERED):
        super().__init__(remembered)
        self.ranks = read_ranks(path)
        self.token = {r: t for t, r in self.ranks.items()}
        self.size = {r: len(t) for r, t in self.token.items()}
        self.name = {r: str(r) for r in self.token}
        self.said = {self.name[r]: t for r, t in self.token.items()}
        self.reach = max(map(len, self.ranks))
        self.pattern = regex.compile(pattern)
        self.halves: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        usable: dict[bytes, int] = {}
        self.fits: dict[int, bool] = {}
        for rank, token in sorted(self.token.items()):
            if len(token) == 1:
                usable[token] = rank
            elif parts := self._last_merge(token, rank):
                usable[token], self.halves[rank], self.joined[parts] = rank, parts, rank
        # all tokens that end at a byte, longest first, of which most byte strings have few
        self.ends = ahocorasick.Automaton()
        for token, rank in usable.items():
            self.ends.add_word(token.decode("latin-1"), (len(token), rank))
        self.ends.make_automaton()
        # the same for many pieces at once: the trie of all tokens (0 is its root) and the token of each of its nodes, halves by token and what two are joined to
        trie: dict[int, int] = {}
        node_of: dict[int, int] = {}
        for token, rank in usable.items():
            at = 0
            for byte in token:
                at = trie.setdefault(at << 8 | byte, len(trie) + 1)
            node_of[at] = rank
        self.step, self.token_at = Lookup(trie), np.full(len(trie) + 1, -1, np.int64)
        self.token_at[[*node_of]] = [*node_of.values()]
        self.half = np.full((2, max(self.ranks.values(), default=0) + 1), -1, np.int64)
        for rank, parts in self.halves.items():
            self.half[:, rank] = parts
        self.sizes = np.zeros(self.half.shape[1], np.int64)
        self.sizes[[*self.size]] = [*self.size.values()]
        self.join = Lookup({a << 32 | b: rank for (a, b), rank in self.joined.items()})

    def _last_merge(self, token: bytes, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one, or None if merging its bytes never gets there."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best, at = min(((self.ranks.get(parts[i] + parts[i + 1], rank), i) for i in range(len(parts) - 1)))
            if best >= rank:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def fit(self, a: int, b: int) -> bool:
        """Whether merging the bytes of a and b gives just these two tokens: no merge across their border comes before both are whole."""
        x, y, before, halves, joined = a, b, 1 << 60, self.halves, self.joined
        while joined.get((x, y), before) >= before:
            # undo whichever of the two was made last; a merge across the border must then come before it
            if x in halves and (y not in halves or x > y):
                before, x = x, halves[x][1]
            elif y in halves:
                before, y = y + 1, halves[y][0]
            else:
                return True
        return False

    def extend(self, piece: bytes, last: list[int]) -> list[int]:
        """Append to last (the last token of each shorter prefix) what the rest of the piece needs. Appending bytes needs no more than this."""
        done, fits, fit = len(last), self.fits, self.fit
        first = max(0, done + 1 - self.reach)  # no token that ends behind what is done starts before this
        for at, (size, t) in self.ends.iter(piece[first:].decode("latin-1")):
            at += first
            if at == done:
                if size <= at:
                    before = last[at - size]
                    if (known := fits.get(before << 32 | t)) is None:
                        if len(fits) >= FITS:
                            fits.clear()
                        known = fits[before << 32 | t] = fit(before, t)
                    if not known:
                        continue
                last.append(t)
                done += 1
        return last

    def fit_all(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """fit of many pairs of tokens."""
        out, rows, x, y, before = np.ones(len(a), bool), np.arange(len(a)), a, b, np.full(len(a), 1 << 60)
        while len(rows):
            made = self.join(x << 32 | y)
            apart = (made < 0) | (made >= before)
            out[rows[~apart]] = False
            left, right = self.half[1, x], self.half[0, y]
            first = (left >= 0) & ((right < 0) | (x > y))
            on = np.flatnonzero(apart & (first | (right >= 0)))
            x, y, first, left, right, rows = x[on], y[on], first[on], left[on], right[on], rows[on]
            before = np.where(first, x, y + 1)
            x, y = np.where(first, left, x), np.where(first, y, right)
        return out

    def extend_all(self, pieces: list[bytes]) -> np.ndarray:
        """The last token of each shorter prefix, a row for each place and a column for each of some sorted pieces. What a piece shares with the one before is taken from there."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        width, n = int(size.max()), len(pieces)
        raw = np.zeros((n, width), np.uint8)
        raw[np.arange(width) < size[:, None]] = np.frombuffer(b"".join(pieces), np.uint8)
        same = np.zeros(n, np.int64)
        same[1:] = np.minimum(np.logical_and.accumulate(raw[1:] == raw[:-1], axis=1).sum(axis=1), np.minimum(size[1:], size[:-1]))
        raw, last = np.ascontiguousarray(raw.T).astype(np.int64), np.full((width, n), -1, np.int64)
        for start in range(width):
            # tokens from here on, by a walk down the trie; of those that end at a place longer ones have come before
            rows = np.flatnonzero(size > start)
            node = np.zeros(len(rows), np.int64)
            for end in range(start, width):
                node = self.step(node << 8 | raw[end, rows])
                on = node >= 0
                t = self.token_at[node]
                new = np.flatnonzero(on & (t >= 0) & (same[rows] <= end) & (last[end, rows] < 0))
                if start:
                    new = new[self.fit_all(last[start - 1, rows[new]], t[new])]
                last[end, rows[new]] = t[new]
                on &= size[rows] > end + 1
                rows, node = rows[on], node[on]
                if not len(rows):
                    break
            last[start] = last[start, np.maximum.accumulate(np.where(same <= start, np.arange(n), 0))]
        return last

    def walk_all(self, pieces: list[bytes], last: np.ndarray) -> Iterator[list[int]]:
        """walk of each of the pieces."""
        end, rows, out = np.fromiter(map(len, pieces), np.int64, len(pieces)), np.arange(len(pieces)), []
        while len(rows):
            t = last[end - 1, rows]
            out.append((rows, t))
            end = end - self.sizes[t]
            rows, end = rows[end > 0], end[end > 0]
        rows, t = (np.concatenate(c[::-1]) for c in zip(*out))
        order = np.argsort(rows, kind="stable")
        t, ends = t[order].tolist(), np.cumsum(np.bincount(rows, minlength=len(pieces))).tolist()
        yield from (t[a:b] for a, b in zip([0, *ends], ends))

    def edit(self, piece: bytes, last: list[int], at: int, removed: int, added: bytes) -> tuple[bytes, list[int]]:
        """The piece with some bytes replaced, and its last tokens. Prefixes before the edit stay; behind it, work ends once as many tokens as the longest token has bytes agree with the old ones."""
        new = piece[:at] + added + piece[at + removed :]
        now, shift, same = last[:at], len(added) - removed, 0
        while len(now) < len(new):
            self.extend(new[: len(now) + 1], now)
            old = len(now) - 1 - shift
            inside = len(now) > at + len(added) and len(self.token[now[-1]]) <= len(now) - at - len(added)
            same = same + 1 if inside and last[old] == now[-1] else 0
            if same >= self.reach:
                now += last[old + 1 :]
        return new, now

    def walk(self, piece: bytes, last: list[int]) -> list[int]:
        out, end, size = [], len(piece), self.size
        while end:
            out.append(t := last[end - 1])
            end -= size[t]
        return out[::-1]

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        return [whole] if whole is not None else self.walk(piece, self.extend(piece, []))

    def work(self, piece: str) -> str:
        return ",".join([self.name[t] for t in self.encode_piece(piece.encode())])

    def learn(self, pieces: set[str]) -> None:
        """Have pieces ready. New ones come in order, so that what each shares with the one before is worked out once."""
        new = sorted([p for p in pieces if p not in self])  # in order of their bytes, too
        self.make_room(len(new))
        older, ranks, names, short, long = self.older, self.ranks, self.name, [], []
        for piece in new:
            if (known := older.get(piece)) is not None:
                self[piece] = known
            elif (whole := ranks.get(raw := piece.encode())) is not None:
                self[piece] = names[whole]
            else:
                (short if len(raw) <= LONG else long).append((piece, raw))
        for at in range(0, len(short), ROWS):
            some, raws = zip(*short[at : at + ROWS])
            for piece, ids in zip(some, self.walk_all(raws, self.extend_all(raws))):
                self[piece] = ",".join([names[t] for t in ids])
        last, before = [], b""
        for piece, raw in long:
            same = 0
            for a, b in zip(before, raw):
                if a != b:
                    break
                same += 1
            before, last = raw, self.extend(raw, last[:same])
            self[piece] = ",".join([names[t] for t in self.walk(raw, last)])

    def encode_all(self, texts: list[str]) -> Iterator[str]:
        """Each text's ids as decimal text joined by commas. Pieces, which take many times the room of their text, are held for some texts at a time."""
        at = 0
        while at < len(texts):
            end, room = at + 1, AT_ONCE - len(texts[at])
            while end < len(texts) and (room := room - len(texts[end])) >= 0:
                end += 1
            yield from self.encode_some(texts[at:end])
            at = end

    def encode_some(self, texts: list[str]) -> list[str]:
        cut = [self.pattern.findall(t) for t in texts]
        pieces = set().union(*cut)
        self.learn(pieces)
        out = [",".join(map(self.__getitem__, of)) for of in cut]
        for piece in pieces:
            if len(piece) > self.longest:
                self.pop(piece, None)
        return out

    def encode(self, text: str) -> str:
        return self.encode_some([text])[0]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))

    def decode_said(self, said: list[str]) -> bytes:
        """What ids written as decimal text stand for."""
        return b"".join(map(self.said.__getitem__, said))


def encoder(path: str, pattern: str, remembered: int = REMEMBERED) -> PrefixEncoder:
    return one_model(PrefixEncoder, path, pattern, remembered)


def encode(text: Column, path: str, pattern: str) -> Column:
    """A text's ids as array<int>; null counts as the empty text."""

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        said = encoder(path, pattern).encode_all([t or "" for t in texts])
        return pd.Series([np.fromstring(s, np.int32, sep=",") for s in said])

    return ids(text)


def decode(ids: Column, path: str, pattern: str) -> Column:
    """The bytes that an array of ids stands for; null stays null."""

    @F.pandas_udf("binary")
    def raw(rows: pd.Series) -> pd.Series:
        of = encoder(path, pattern)
        return pd.Series([None if r is None else of.decode(list(r)) for r in rows])

    return raw(ids)


def digests(path: str, pattern: str, texts: pd.Series, with_ids: bool, remembered: int = REMEMBERED) -> pd.DataFrame:
    """What each text (none null) is encoded to and decoded from."""
    of, rows = encoder(path, pattern, remembered), []
    for said in of.encode_all(texts.tolist()):
        ids = said.split(",") if said else []
        row = (len(ids), hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(of.decode_said(ids)).hexdigest())
        rows.append((np.fromstring(said, np.int32, sep=","), *row) if with_ids else row)
    return pd.DataFrame(rows, columns=["ids"] * with_ids + ["n_tokens", "ids_sha256", "decoded_sha256"])


def encoded(docs: DataFrame, path: str, pattern: str, text_col: str = "text", remembered: int = REMEMBERED) -> DataFrame:
    """docs with ids (array<int>), n_tokens, ids_sha256 (of the ids as decimal text joined by commas) and decoded_sha256 (of the bytes that they decode to). remembered: as REMEMBERED, where workers have less memory or more."""

    @F.pandas_udf("ids array<int>, n_tokens long, ids_sha256 string, decoded_sha256 string")
    def made(texts: pd.Series) -> pd.DataFrame:
        return digests(path, pattern, texts, True, remembered)

    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), made(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("bpe"))
    return rows.select("row.*", "bpe.ids", "bpe.n_tokens", "bpe.ids_sha256", "bpe.decoded_sha256")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text, decode its ids, and give digests of both: id, n_tokens, ids_sha256, decoded_sha256.

    One row per input row, repeated rows included. A null or empty text has no ids (digests of nothing); a null id is
    passed on. Texts of any length are encoded whole. An empty table gives an empty result; other columns are ignored.
    """

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def made(texts: pd.Series) -> pd.DataFrame:
        return digests(path, pattern, texts, False)

    got = docs.select(F.col(id_col).alias("doc_id"), made(F.coalesce(F.col(text_col), F.lit(""))).alias("d"))
    return got.select("doc_id", "d.n_tokens", "d.ids_sha256", "d.decoded_sha256")
