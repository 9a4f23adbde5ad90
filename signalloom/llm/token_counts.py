"""Token counts by heap-and-linked-list byte-pair merging.

A text's count is the number of its initial symbols (bytes) less the number of merges; no identifiers are made.
Python is needed since merging is a loop whose next step depends on the last one.
"""

from __future__ import annotations

import heapq
import json

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalloom.llm.common import one_model

#: How a byte-level vocabulary file splits text before merging (fixed value of the format).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Distinct words whose counts a worker remembers; beyond that it starts afresh.
REMEMBERED = 400_000


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabulary files."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class MergeCounter(dict):
    """Word -> number of tokens, worked out when first asked for."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids = spec["model"]["vocab"]
        self.symbol = [ids[c] for _, c in sorted(byte_symbols().items())]
        self.left, self.right, self.made, self.rank = [], [], [], {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank.setdefault(ids[a] << 32 | ids[b], rank)
            self.left.append(ids[a])
            self.right.append(ids[b])
            self.made.append(ids[a + b])
        specials = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        self.split = regex.compile(SPLIT)

    def merges(self, word: bytes) -> int:
        """How many merges the word undergoes. Pairs wait in a heap by rank, then position; a linked list holds the symbols that are left."""
        sym = [self.symbol[b] for b in word]
        n, rank_of, left, right, made = len(sym), self.rank.get, self.left, self.right, self.made
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [r << 32 | i for i in range(n - 1) if (r := rank_of(sym[i] << 32 | sym[i + 1])) is not None]
        heapq.heapify(heap)
        done = 0
        while heap:
            at = heapq.heappop(heap)
            rank, i = at >> 32, at & 0xFFFFFFFF
            j = after[i]
            if j >= n or sym[i] != left[rank] or sym[j] != right[rank]:
                continue  # one of the pair has been merged since
            sym[i], sym[j] = made[rank], -1
            after[i] = k = after[j]
            done += 1
            if k < n:
                before[k] = i
                if (r := rank_of(sym[i] << 32 | sym[k])) is not None:
                    heapq.heappush(heap, r << 32 | i)
            if (h := before[i]) >= 0 and (r := rank_of(sym[h] << 32 | sym[i])) is not None:
                heapq.heappush(heap, r << 32 | h)
        return done

    def __missing__(self, word: str) -> int:
        raw = word.encode()
        n = len(raw) - self.merges(raw)
        if len(self) >= REMEMBERED:
            self.clear()
        if len(raw) <= 64:
            self[word] = n
        return n

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        parts = self.special.split(text) if self.special else [text]
        return len(parts) - 1 + sum(sum(map(self.__getitem__, self.split.findall(p))) for p in parts)


def counter(path: str) -> MergeCounter:
    return one_model(MergeCounter, path)


def token_count(text: Column, path: str) -> Column:
    """Tokens of a text under the byte-level vocabulary file at path; null counts as the empty text, which has 0."""

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        of = counter(path)
        return pd.Series([of.count(t) for t in texts], dtype="int64")

    return count(text)


def count_tokens(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row, repeated rows included: id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    Nulls: a null text is an empty one (0 bytes, 0 tokens, not over); a null id is passed on. Texts of any length are
    counted whole. An empty table gives an empty result. Columns besides the two named ones are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    counted = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), token_count(text, path).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
