"""Removal of repeated passages by a sparse suffix array.

Of each text only some suffixes are taken: those that start where a hash of 32 bytes is the least (the first such, on ties) of all
in some window as long as a passage. Where a window's suffix starts depends on the window's bytes alone, so equal windows
choose alike: a window is repeated just where another suffix of the same leading bytes continues alike to the window's end
and is preceded alike back to its start.

1. Suffixes that agree in all windows that chose them are found by hashes; these windows are repeated.
2. Of the others, those whose leading bytes occur elsewhere go by range, with sampled splitters over their leading bytes, into
   buckets. A bucket is sorted by multikey quicksort; each run of suffixes with a common prefix is sorted by what precedes
   them, and neighbours are compared both ways. Suffixes of the same leading bytes never lie on both sides of a bucket's border.
3. Leading bytes that a crowd of different suffixes share (a passage in a third of all documents, say) would make a bucket
   of any size. They are told apart further first: the windows are halved by where the suffix starts in them, suffixes that agree in all that
   is left are found by hashes, and those that share what all these windows have in common stay together, until no crowd is left.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalloom.llm.common import discard, keep, tidy

#: Leading bytes of a suffix; as a power of two.
LEAD_BITS = 5
LEAD = 1 << LEAD_BITS
#: Places that are hashed at once, and the bits that number them.
PLACE_BITS = 20
#: Different suffixes of the same leading bytes that one bucket holds together.
CROWD = 1000
#: Parts that a crowd of equal suffixes is dealt to, and crowds that are few enough to go to every task.
PARTS, FEW = 64, 100_000
MIX = np.random.default_rng(0x5EED).integers(0, 1 << 63, 256, dtype=np.uint64)
ODD = np.uint64(0x9E3779B97F4A7C15)


def lead_hashes(raw: np.ndarray) -> np.ndarray:
    """A hash of the LEAD bytes from each place on."""
    h, by = MIX[raw], ODD
    with np.errstate(over="ignore"):
        for b in range(LEAD_BITS):
            h = h[: -(1 << b)] * by + h[1 << b :]
            by = by * by
        h ^= h >> np.uint64(32)
        h *= ODD
        h ^= h >> np.uint64(29)
    return h


def least_places(h: np.ndarray, width: int) -> np.ndarray:
    """For each window of so many hashes, the place of the least (the first, on ties)."""
    low = np.uint64((1 << PLACE_BITS) - 1)
    key, span = (h & ~low) | np.arange(len(h), dtype=np.uint64), 1
    while span < width:
        step = min(span, width - span)
        key = np.minimum(key[:-step], key[step:])
        span += step
    return (key & low).astype(np.int64)


def chosen(raw: bytes, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Chosen suffixes of a text: where they start, the first and the last of the windows (of size bytes) that choose them, and the hash of their leading bytes."""
    data, windows = np.frombuffer(raw, np.uint8), len(raw) - size + 1
    step, parts = (1 << PLACE_BITS) - size, []
    for at in range(0, max(windows, 0), step):
        h = lead_hashes(data[at : min(at + step, windows) + size - 1])
        place = least_places(h, size - LEAD + 1)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        parts.append((place[first] + at, first + at, np.concatenate([first[1:], [len(place)]]) - 1 + at, h[place[first]].view(np.int64)))
    if not parts:
        return (np.zeros(0, np.int64),) * 4
    q, lo, hi, h = map(np.concatenate, zip(*parts))
    new = np.concatenate([[True], q[1:] != q[:-1]])  # a suffix may be chosen on both sides of a step
    return q[new], lo[new], hi[np.concatenate([np.flatnonzero(new)[1:], [len(q)]]) - 1], h[new]


def shared_length(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    a, b = a[:n], b[:n]
    if a == b:
        return n
    return n - ((int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_length() + 7) // 8


def multikey_sort(items: list, text, step: int = 8) -> list:
    """Items in the order of text(item), by three-way partitions on step bytes at a time."""
    out, todo = [], [(items, 0, False)]
    while todo:
        now, at, same = todo.pop()
        if same or len(now) <= 24:
            out += now if same else sorted(now, key=text)
            continue
        pivot = sorted(text(now[i])[at : at + step] for i in (0, len(now) // 2, -1))[1]
        parts: tuple[list, list, list] = ([], [], [])
        for x in now:
            t = text(x)[at : at + step]
            parts[1 + (t > pivot) - (t < pivot)].append(x)
        todo += [(parts[2], at, False), (parts[1], at + step, len(pivot) < step), (parts[0], at, False)]
    return out


def common_runs(after: list[bytes]):
    """Of sorted texts, each run with a longer common prefix than its surroundings: first, last, length of the prefix, of the surroundings'."""
    lcp, stack = [shared_length(a, b) for a, b in zip(after, after[1:])], []
    for i, d in enumerate([*lcp, -1]):
        first = i
        while stack and stack[-1][1] >= d:
            first, top = stack.pop()
            if top > d:
                yield first, i, top, max(d, stack[-1][1] if stack else -1)
        stack.append((first, d))


def repeated_in_group(group: list[tuple], size: int):
    """Of suffixes (after, before, least, most, ...) with the same leading bytes: (suffix, a, b) if the windows in which it starts a to b bytes from the start are repeated.

    before is reversed. A window in which the suffix starts o bytes from the start is repeated if another suffix shares o
    bytes before and size - o after.
    """
    group = multikey_sort(group, lambda x: x[0])
    for first, last, prefix, outer in common_runs([x[0] for x in group]):
        run = multikey_sort(group[first : last + 1], lambda x: x[1])
        before = [shared_length(a[1], b[1]) for a, b in zip(run, run[1:])]
        for x, left, right in zip(run, [-1, *before], [*before, -1]):
            a, b = max(size - prefix, x[2]), min(size - outer - 1, x[3], max(left, right))
            if a <= b:
                yield x, a, b


KEY = ["k1", "k2"]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text and two hashes that tell documents apart; rows alike in both have the same."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.select(F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64(F.lit(7), "text", "doc_id").alias("k2"), "doc_id", "text")


def choices(rows: DataFrame, size: int) -> DataFrame:
    """All chosen suffixes: k1, k2, q (start), lo, hi (windows that choose it), lead, scope (hashes of the leading bytes and of all its windows' bytes)."""

    def choose(batches):
        for batch in batches:
            out = []
            for k1, k2, text in zip(batch.k1, batch.k2, batch.text):
                raw = text.encode()
                q, lo, hi, lead = chosen(raw, size)
                if len(q):
                    scope = [xxhash.xxh3_64_intdigest(raw[a : b + size]) for a, b in zip(lo.tolist(), hi.tolist())]
                    out.append((np.full(len(q), k1), np.full(len(q), k2), q, lo, hi, lead, np.array(scope, np.uint64).view(np.int64)))
            if out:
                yield pd.DataFrame(dict(zip(("k1", "k2", "q", "lo", "hi", "lead", "scope"), map(np.concatenate, zip(*out)))))

    return rows.select("k1", "k2", "text").mapInPandas(tidy(choose), "k1 long, k2 long, q long, lo long, hi long, lead long, scope long")


def contexts(rows: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """What stands around suffixes: k1, k2, q, least, most (bytes from a window's start), lead, after, before (reversed)."""

    def cut(batches):
        for batch in batches:
            out = []
            for k1, k2, text, places in zip(batch.k1, batch.k2, batch.text, batch.places):
                raw = text.encode()
                for p in places:
                    q, lo, hi = p["q"], p["lo"], p["hi"]
                    out.append((k1, k2, q, q - hi, q - lo, p["lead"], raw[q : hi + size], raw[lo:q][::-1]))
            yield pd.DataFrame(out, columns=["k1", "k2", "q", "least", "most", "lead", "after", "before"])

    places = wanted.groupBy(*KEY).agg(F.collect_list(F.struct("q", "lo", "hi", "lead")).alias("places"))
    joined = rows.select("k1", "k2", "text").join(places, KEY)
    return joined.mapInPandas(tidy(cut), "k1 long, k2 long, q long, least long, most long, lead long, after binary, before binary")


def sorted_buckets(found: DataFrame, size: int) -> DataFrame:
    """Repeated windows (k1, k2, lo, hi) of suffixes in groups (g1, g2) that are no crowds."""

    def compare(batches):
        held, of = [], None
        out: list = []

        def done():
            return ((x[4], x[5], x[6] - b, x[6] - a) for x, a, b in repeated_in_group(held, size)) if len(held) > 1 else ()

        for batch in batches:
            for row in zip(batch.after, batch.before, batch.least, batch.most, batch.k1, batch.k2, batch.q, batch.g1, batch.g2):
                if row[7:] != of:
                    out += done()
                    held, of = [], row[7:]
                held.append(row)
            yield pd.DataFrame(out, columns=["k1", "k2", "lo", "hi"])
            out = []
        yield pd.DataFrame(done(), columns=["k1", "k2", "lo", "hi"])

    # the splitters' sample must not run what made the rows a second time, so these have been written
    leading = found.withColumn("leading", F.substring("after", 1, LEAD))
    ranged = leading.repartitionByRange("leading", "g1", "g2").sortWithinPartitions("leading", "g1", "g2").drop("leading")
    return ranged.mapInPandas(tidy(compare), "k1 long, k2 long, lo long, hi long")


def halve_crowds(found: DataFrame, size: int) -> tuple[DataFrame, list[DataFrame], list[DataFrame]]:
    """Split crowds until none is left: suffixes in groups that are none, repeated windows (k1, k2, lo, hi) found on the way, and the tables kept for both."""
    width = 1 << (size - 1).bit_length()
    crowd = found.withColumn("base", F.lit(0).cast("long"))
    calm, spans, kept = [], [], []
    while width > 1 and not crowd.isEmpty():
        width //= 2
        halves = crowd.drop("g1", "g2", "kinds").withColumn("base", F.explode(F.array(F.col("base"), F.col("base") + width)))
        halves = halves.withColumn("least", F.greatest("least", "base")).withColumn("most", F.least("most", F.col("base") + width - 1)).where("least <= most")
        part = lambda a, b: (F.substring(F.col("before"), F.lit(1), a.cast("int")), F.substring(F.col("after"), F.lit(1), b.cast("int")))
        core = (F.col("lead"), F.col("base"), *part(F.col("base"), F.lit(size) - F.col("base") - (width - 1)))
        scope = (F.col("least"), F.col("most"), *part(F.col("most"), F.lit(size) - F.col("least")))
        halves = halves.withColumns({"g1": F.xxhash64(F.lit(1), *core), "g2": F.xxhash64(F.lit(2), *core), "s1": F.xxhash64(F.lit(3), *scope), "s2": F.xxhash64(F.lit(4), *scope)})
        halves = keep(halves, "suffix-halves")
        same = halves.groupBy("g1", "g2", "s1", "s2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("k1", "k2", "q")).alias("one"))
        groups = same.groupBy("g1", "g2").agg(F.count(F.lit(1)).alias("kinds"))
        same = keep(same.join(groups, ["g1", "g2"]).where("n > 1 or kinds > 1"), "suffix-same")
        marked = keep(halves.join(same, ["g1", "g2", "s1", "s2"]), "suffix-marked")
        discard(halves, same)
        kept.append(marked)
        spans.append(marked.where("n > 1").select("k1", "k2", (F.col("q") - F.col("most")).alias("lo"), (F.col("q") - F.col("least")).alias("hi")))
        ones = marked.where("kinds > 1").where(F.col("one") == F.struct("k1", "k2", "q")).drop("s1", "s2", "n", "one")
        calm.append(ones.where(F.col("kinds") <= CROWD).select(found.columns))
        crowd = ones.where(F.col("kinds") > CROWD)
    out = calm[0] if calm else crowd.limit(0).select(found.columns)
    for c in calm[1:]:
        out = out.unionByName(c)
    return out, spans, kept


def scopes(every: DataFrame, alike: list[str]) -> DataFrame:
    """Of chosen places (k1, k2, q, lo, hi): each kind (columns alike, the first of which is the lead) whose lead occurs elsewhere, with n (how many), one of them, and kinds (of that lead)."""
    same = every.groupBy(*alike).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("k1", "k2", "q", "lo", "hi")).alias("one"))
    leads = same.groupBy("lead").agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("kinds")).where(F.col("all") > 1).drop("all")
    return same.join(leads, "lead")


def equal_rows(every: DataFrame, same: DataFrame, alike: list[str]) -> DataFrame:
    """The rows of every whose kind occurs more than once. A passage in a third of all documents is one key: its rows are dealt over parts, and the key is in each of them."""
    keys = same.where("n > 1").withColumn("part", F.explode(F.when(F.col("n") > CROWD, F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(-1)))))
    hot = same.where(F.col("n") > CROWD).select(*alike, F.lit(True).alias("hot"))
    n_hot, part = hot.count(), F.lit(-1)
    if n_hot:
        every = every.join(F.broadcast(hot) if n_hot <= FEW else hot, alike, "left")
        part = F.when(F.col("hot"), F.pmod(F.xxhash64("k1", "k2", "q"), F.lit(PARTS)).cast("int")).otherwise(-1)
    return every.withColumn("part", part).join(keys.select(*alike, "part"), [*alike, "part"])


def repeated_windows(rows: DataFrame, size: int) -> DataFrame:
    """k1, k2 and spans: per document the first and last starts of runs of windows that also start elsewhere."""
    every = keep(choices(rows, size).withColumns({"least": F.col("q") - F.col("hi"), "most": F.col("q") - F.col("lo")}), "suffix-choices")
    alike = ["lead", "scope", "least", "most"]
    same = keep(scopes(every, alike), "suffix-scopes")
    spans = [equal_rows(every, same, alike).select("k1", "k2", "lo", "hi")]

    wanted = same.where("kinds > 1").select("lead", "kinds", "one.*")
    found = contexts(rows, wanted, size).join(wanted.select("k1", "k2", "q", "kinds"), ["k1", "k2", "q"])
    found = keep(found.withColumns({"g1": F.col("lead"), "g2": F.lit(0).cast("long")}), "suffix-contexts")
    calm, more, kept = halve_crowds(found.where(F.col("kinds") > CROWD), size)
    spans += more
    spans.append(sorted_buckets(found.where(F.col("kinds") <= CROWD), size))
    if more:
        kept.append(keep(calm, "suffix-calm"))
        spans.append(sorted_buckets(kept[-1], size))
    out = spans[0]
    for x in spans[1:]:
        out = out.unionByName(x)
    out = keep(out.groupBy(*KEY).agg(F.collect_set(F.struct("lo", "hi")).alias("spans")), "suffix-spans")
    discard(every, same, found, *kept)
    return out


def kept_bytes(raw: bytes, spans, size: int) -> tuple[bytes, int]:
    """What is left of a text, and the number of runs removed. spans: first and last start of repeated windows."""
    parts, at, runs = [], 0, 0
    for lo, hi in sorted((s["lo"], s["hi"] + size) for s in spans):
        if lo > at or not runs:
            parts.append(raw[at:lo])
            runs += 1
        at = max(at, hi)
    parts.append(raw[at:])
    return b"".join(parts), runs


def removal(text: Column, spans: Column, size: int) -> Column:
    """n_bytes, n_removed, n_spans, kept (bytes) and kept_sha256 of a text less its repeated windows."""

    @F.pandas_udf("n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
    def remove(texts: pd.Series, each: pd.Series) -> pd.DataFrame:
        rows = []
        for text, of in zip(texts, each):
            raw = text.encode()
            left, runs = kept_bytes(raw, of, size) if of is not None and len(of) else (raw, 0)
            rows.append((len(raw), len(raw) - len(left), runs, left, hashlib.sha256(left).hexdigest()))
        return pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    return remove(text, spans)


def remove_repeats(docs: DataFrame, size: int = 400, words: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove each byte covered by a string of `size` bytes that also starts anywhere else, in the same text or another.

    One row per input row: doc_id, n_bytes, n_removed, n_spans (maximal runs removed), kept (the bytes left), kept_sha256. If `words` is given, also
    n_repeated_words: how many words stand in runs of so many that also start elsewhere, however many bytes they have; nothing is removed for them.
    Strings are judged on the input and don't cross texts; overlapping ones count. Null texts are empty ones; null ids are
    ids like any other; repeated rows lose all that is long enough. Texts shorter than `size` lose nothing. An empty table
    gives an empty result; other columns are ignored. `size` is at least 64, `words` at least 26.
    """
    if size < 2 * LEAD or words is not None and words < GRAM:
        raise ValueError(f"size must be at least {2 * LEAD}, words at least {GRAM}")
    rows = keyed(docs, id_col, text_col)
    joined = rows.join(repeated_windows(rows, size), KEY, "left")
    if words is not None:
        joined = joined.join(repeated_word_windows(rows, words).select(*KEY, covered(F.col("spans"), words).alias("n")), KEY, "left")
    more = [] if words is None else [F.coalesce("n", F.lit(0)).cast("long").alias("n_repeated_words")]
    return joined.select("doc_id", removal(F.col("text"), F.col("spans"), size).alias("r"), *more).select("doc_id", "r.*", *(["n_repeated_words"] if more else []))


def covered(spans: Column, words: int) -> Column:
    """How many words are in any of the windows of so many whose first words these spans (lo, hi) hold."""
    first = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))

    def step(s, x):
        end = x["hi"] + F.lit(words)
        return F.struct((s["n"] + F.greatest(F.lit(0), end - F.greatest(x["lo"], s["end"]))).alias("n"), F.greatest(s["end"], end).alias("end"))

    return F.aggregate(F.array_sort(spans), first, step, lambda s: s["n"])


#: Words that are hashed together to choose places in windows of words.
GRAM = 26


def word_places(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word, and the byte behind its last."""
    data = np.frombuffer(raw, np.uint8)
    edges = np.flatnonzero(np.diff(np.concatenate([[True], (data == 32) | ((data >= 9) & (data <= 13)), [True]]).astype(np.int8)))
    return edges[::2], edges[1::2]


def run_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n hashes in a row."""
    out, length, block, span, by = None, 0, h, 1, ODD
    with np.errstate(over="ignore"):
        while n:
            if n & 1:  # the block stands before what there is
                out = block if out is None else block[: max(len(out) - span, 0)] * np.uint64(pow(int(ODD), length, 1 << 64)) + out[span:]
                length += span
            n >>= 1
            if n:
                block, by, span = block[: max(len(block) - span, 0)] * by + block[span:], by * by, 2 * span
        out = out ^ (out >> np.uint64(32))
        out *= ODD
        return out ^ (out >> np.uint64(29))


def word_choices(raw: bytes, words: int) -> tuple[np.ndarray, ...]:
    """Places that windows of so many words choose: the first of GRAM words (those of the least hash in a window, the first on ties), the first and the last window that choose it, the hash of the GRAM words, and the hashes of all words."""
    each = np.array([xxhash.xxh3_64_intdigest(w) for w in raw.split()], np.uint64)
    windows, step, parts = len(each) - words + 1, (1 << PLACE_BITS) - words, []
    for at in range(0, max(windows, 0), step):
        grams = run_hashes(each[at : min(at + step, windows) + words - 1], GRAM)
        place = least_places(grams, words - GRAM + 1)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        parts.append((place[first] + at, first + at, np.concatenate([first[1:], [len(place)]]) - 1 + at, grams[place[first]].view(np.int64)))
    if not parts:
        return *(np.zeros(0, np.int64),) * 4, each
    q, lo, hi, h = map(np.concatenate, zip(*parts))
    new = np.concatenate([[True], q[1:] != q[:-1]])  # a place may be chosen on both sides of a step
    return q[new], lo[new], hi[np.concatenate([np.flatnonzero(new)[1:], [len(q)]]) - 1], h[new], each


def repeated_word_windows(rows: DataFrame, words: int) -> DataFrame:
    """k1, k2 and spans: per document (of rows: k1, k2, text) the first and last first words (lo, hi) of runs of windows of so many words that also start elsewhere.

    Equal windows choose alike. Places that agree in all windows that chose them are found by hashes; of those that don't, one of each kind has its windows
    compared one by one, by a hash of all their words and that of their choice.
    """
    names, kind = ["k1", "k2", "q", "lo", "hi", "lead", "scope"], "k1 long, k2 long, q long, lo long, hi long, lead long, scope long"

    def choose(batches):
        for batch in batches:
            out = []
            for k1, k2, text in zip(batch.k1, batch.k2, batch.text):
                q, lo, hi, lead, each = word_choices(text.encode(), words)
                if len(q):
                    scope = [xxhash.xxh3_64_intdigest(each[a : b + words].tobytes()) for a, b in zip(lo.tolist(), hi.tolist())]
                    out.append((np.full(len(q), k1), np.full(len(q), k2), q, lo, hi, lead, np.array(scope, np.uint64).view(np.int64)))
            if out:
                yield pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*out)))))

    every = rows.select("k1", "k2", "text").mapInPandas(tidy(choose), kind)
    every = keep(every.withColumns({"least": F.col("q") - F.col("hi"), "most": F.col("q") - F.col("lo")}), "word-choices")
    alike = ["lead", "scope", "least", "most"]
    same = keep(scopes(every, alike), "word-scopes")
    spans = equal_rows(every, same, alike).select("k1", "k2", "lo", "hi")

    def compare(batches):
        for batch in batches:
            out = [(np.zeros(0, np.int64),) * 5]
            for k1, k2, text, places in zip(batch.k1, batch.k2, batch.text, batch.places):
                each = np.array([xxhash.xxh3_64_intdigest(w) for w in text.encode().split()], np.uint64)
                for p in places:
                    at = np.arange(p["lo"], p["hi"] + 1)
                    whole = run_hashes(each[p["lo"] : p["hi"] + words], words).view(np.int64)
                    out.append((np.full(len(at), k1), np.full(len(at), k2), at, np.full(len(at), p["lead"]), whole))
            yield pd.DataFrame(dict(zip(("k1", "k2", "lo", "lead", "whole"), map(np.concatenate, zip(*out)))))

    wanted = same.where("kinds > 1").select("lead", "one.*").groupBy(*KEY).agg(F.collect_list(F.struct("lo", "hi", "lead")).alias("places"))
    looked = rows.select("k1", "k2", "text").join(wanted, KEY).mapInPandas(tidy(compare), "k1 long, k2 long, lo long, lead long, whole long")
    looked = keep(looked, "word-windows")
    again = looked.groupBy("whole", "lead").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("whole", "lead")
    spans = spans.unionByName(looked.join(again, ["whole", "lead"]).select("k1", "k2", "lo", F.col("lo").alias("hi")))
    out = keep(spans.groupBy(*KEY).agg(F.collect_set(F.struct("lo", "hi")).alias("spans")), "word-spans")
    discard(every, same, looked)
    return out


def cut_repeats(docs: DataFrame, words: int = 51) -> DataFrame:
    """docs (with doc_id, text and n_chars) less each word of a run of so many words that also starts elsewhere, in the same text or another, and the blanks within such runs; texts that lost all their words go with their rows.

    Words are told apart by their bytes, whatever blanks lie between them. `words` is at least GRAM. Every place of a repeated
    run goes, the first included, so there are no ties to settle; rows repeated whole lose all such runs alike. Null texts stay null, with their n_chars, and like
    empty or blank ones stay rows. Null ids are ids like any other. An empty table gives an empty result; other columns stay as they are, whatever their names.
    """
    if words < GRAM:
        raise ValueError(f"words must be at least {GRAM}")
    text = F.coalesce(F.col("text"), F.lit(""))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = docs.select(F.xxhash64("doc_id", text).alias("k1"), F.xxhash64(F.lit(7), text, "doc_id").alias("k2"), text.alias("text"), row)
    found = repeated_word_windows(rows, words)

    @F.pandas_udf("string")
    def kept(texts: pd.Series, each: pd.Series) -> pd.Series:
        out = []
        for t, of in zip(texts, each):
            if of is not None and len(of):
                raw = t.encode()
                first, behind = word_places(raw)
                t = kept_bytes(raw, [{"lo": first[s["lo"]], "hi": behind[s["hi"] + words - 1]} for s in of], 0)[0].decode()
            out.append(t)
        return pd.Series(out)

    left = rows.join(found, KEY, "left").select("row", "spans", kept("text", "spans").alias("left"))
    left = left.where(F.col("spans").isNull() | F.col("left").rlike(r"[^\x20\x09-\x0D]"))
    changed = F.col("row").withField("text", F.col("left")).withField("n_chars", F.length("left").cast("long"))
    return left.select(F.when(F.col("row.text").isNull(), F.col("row")).otherwise(changed).alias("row")).select("row.*")
