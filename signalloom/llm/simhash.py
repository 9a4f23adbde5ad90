"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint of 64 bits is cut into blocks. If two fingerprints differ in at most d bits, then at least (blocks - d) of
their blocks are equal; so each choice of so many blocks is a key, pairs that share a key are candidates, and the Hamming
distance decides. Only distinct fingerprints are joined. A key that many fingerprints share isn't joined pair by pair: its
fingerprints go by all values within d / 2 bits instead (for d = 2, themselves and their one-bit neighbours), which any two linked ones have in common, and
which can't gather more than 65 of them.

Texts may be alike to a wider degree (near_copies: a Jaccard similarity of 0.8 of five-word shingles, say), at which fingerprints of 64 bits
differ in about 10, and no number of blocks finds all pairs. There fingerprints are linked first, as above, and each link is verified by the sets of
shingles; what they miss is found from the sets themselves. With all shingles in one order, two sets so much alike share one of the
first few of each (the prefix filter, which misses nothing); each of these is a key, and rare ones come first in the order. Members of a key that many
share stand in an order, most typical ones first, and are compared with the first of it; then those that aren't in one component yet with the next, a
longer stretch in each round, until no key has members of different components that haven't met. So a group costs rows in proportion to its size.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import chain, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalloom.llm.common import discard, keep, tidy
from signalloom.llm.components import components
from signalloom.llm.suffix_dedup import ODD, run_hashes, word_places

BLOCKS = 4
#: Fingerprints of one key that are joined pair by pair.
CROWD = 256
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingle_hashes(text: str, width: int) -> np.ndarray:
    """XXH64 (seed 42) of a text's shingles of lower-cased words, repeats included."""
    words = text.encode().translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined, hashed = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([hashed(joined, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words))) + np.arange(len(words))
    starts = np.concatenate([[0], ends[:-width] + 1]).tolist()
    return np.array([hashed(joined[a:b], 42) for a, b in zip(starts, ends[width - 1 :].tolist())], np.uint64)


def fingerprint_of(hashes: np.ndarray) -> int:
    """As a signed 64-bit integer: a bit is set if it is in over half of the hashes."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        counts += np.unpackbits(hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def simhash(text: Column, width: int = 3) -> Column:
    """A text's fingerprint as bigint; 0 for a null text or one without words."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(shingle_hashes(t or "", width)) for t in texts], dtype="int64")

    return of(text)


def masks(bits: int) -> list[int]:
    """The bits of each choice of blocks, as signed integers."""
    size = 64 // BLOCKS
    block = [((1 << size) - 1) << size * i for i in range(BLOCKS)]
    sums = [sum(c) for c in combinations(block, BLOCKS - bits)]
    return [s - (1 << 64) if s >= 1 << 63 else s for s in sums]


def links(fingerprints: DataFrame) -> DataFrame:
    """a, b: links that join up all pairs of the distinct fingerprints (bigint fp) that differ in 2 bits or fewer; each is such a pair."""
    keys = F.explode(F.array(*(F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("value")) for i, m in enumerate(masks(2)))))
    keyed = fingerprints.select("fp", keys.alias("k")).select("fp", "k.*")
    shared = keep(keyed.groupBy("choice", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-keys")
    keyed = keep(keyed.join(shared, ["choice", "value"]), "simhash-keyed")

    few = keyed.where(F.col("n") <= CROWD)
    pairs = few.select("choice", "value", F.col("fp").alias("a")).join(few.select("choice", "value", F.col("fp").alias("b")), ["choice", "value"])
    pairs = pairs.where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2)).select("a", "b")

    many = keyed.where(F.col("n") > CROWD).select("fp").distinct()
    bit = lambda i: 1 << i if i < 63 else -(1 << 63)
    near = F.explode(F.array(F.col("fp"), *(F.col("fp").bitwiseXOR(F.lit(bit(i))) for i in range(64))))
    met = many.select("fp", near.alias("near")).groupBy("near").agg(F.array_sort(F.collect_list("fp")).alias("fps")).where(F.size("fps") > 1)
    return pairs.unionByName(met.select(F.element_at("fps", 1).alias("a"), F.explode(F.slice("fps", 2, 64)).alias("b"))).distinct()


def near_duplicates(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, fp (bigint), component_id: the smallest doc_id reachable by fingerprints that differ in 2 bits or fewer.

    Documents of equal fingerprints are linked; those without words (null texts too) have fingerprint 0 and are linked like any
    other. A null id is never the smallest; a component of null ids alone has none. Repeated rows come repeated. Texts of any length
    count whole. An empty table gives an empty result; other columns are ignored.
    """
    rows = keep(docs.select(F.col(id_col).cast("long").alias("doc_id"), simhash(F.col(text_col), width).alias("fp")), "simhash")
    nodes = keep(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    roots = components(links(nodes.select("fp"))).withColumnRenamed("node", "fp")
    placed = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    placed = placed.join(least, "root").select("fp", "component_id")
    return rows.join(placed, "fp").select("doc_id", "fp", "component_id")


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


#: One text in so many is looked at to tell which shingles are common: those in LEAST_COMMON of its texts and in one of COMMON_SHARE, so that there are at most so many times the shingles of a text.
COMMON_OF, LEAST_COMMON, COMMON_SHARE = 16, 8, 2000
#: Members of a bucket that has no leaders; a larger one has two.
BUCKET = 8
#: How many of a bucket's other members, in order, those of other components are compared with in the first round after the leaders, and how many times as many by the end of each further round.
STRETCH = 16
#: Bits of a set's sketch.
SKETCH = 1024
#: What sums of similarities may be off by, which aren't whole numbers.
SLACK = 1e-9


#: A number for each byte, A-Z the same as a-z; none for blanks.
BYTES = np.array([0 if b in b" \t\n\v\f\r" else xxhash.xxh64_intdigest(LOWER[b : b + 1], 42) for b in range(256)], np.uint64)


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each of a text's lower-cased words, all worked out together."""
    raw = text.encode()
    starts, behind = word_places(raw)
    if not len(starts):
        return np.zeros(0, np.uint64)
    data = BYTES[np.frombuffer(raw, np.uint8)[starts[0] : behind[-1]]]
    place = np.arange(starts[0], behind[-1]) - np.repeat(starts, np.diff(starts, append=behind[-1]))
    powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full((behind - starts).max(), ODD))])
    with np.errstate(over="ignore"):
        h = np.add.reduceat(data * powers[np.minimum(place, len(powers) - 1)], starts - starts[0])
        h ^= h >> np.uint64(32)
        h *= ODD
        return h ^ (h >> np.uint64(29))


def run_of_words(text: str, width: int) -> np.ndarray:
    """A 64-bit hash of each of a text's shingles, as shingle_hashes has them, for a use that doesn't fix which hash: without a loop over words."""
    words = word_hashes(text)
    return run_hashes(words, min(width, len(words))) if len(words) else words


def shingle_set(text: str | None, width: int) -> np.ndarray:
    return np.unique(run_of_words(text or "", width))


def prefix_of(hashes: np.ndarray, common: np.ndarray, similarity: float) -> np.ndarray:
    """The first hashes of a set, common ones last, of which two sets of this Jaccard similarity share one at least: all but as many as they share, and one more."""
    if not len(hashes):
        return hashes
    if len(common):
        at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
        hashes = hashes[np.argsort(common[at] == hashes, kind="stable")]
    return hashes[: len(hashes) - math.ceil(similarity * len(hashes) - SLACK) + 1]


def sketch_of(hashes: np.ndarray) -> np.ndarray:
    """Of each of SKETCH classes of hashes, whether a set has an odd number of them, as longs. Two sketches differ in no more bits than the sets in hashes."""
    odd = np.bincount((hashes % SKETCH).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def sketches_allow(n: Column, x: Column, m: Column, y: Column, similarity: float) -> Column:
    """If sets of n and m hashes with the sketches x and y can be alike to this degree: those that are differ in (1 - similarity) / (1 + similarity) of n + m at most."""
    apart = F.aggregate(F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, k: s + k)
    return apart * F.lit(1 + similarity) <= F.lit(1 - similarity) * (n + m) + F.lit(SLACK)


def may_be_alike(n: np.ndarray, at: np.ndarray, m: np.ndarray, bt: np.ndarray, similarity: float) -> np.ndarray:
    """If sets of n and m hashes, the first that they share being in place at and bt of their orders, can be alike to this degree."""
    shared = np.minimum(n - at, m - bt)
    return shared * (1 + similarity) >= similarity * (n + m) - SLACK


def leaders(nodes: np.ndarray, n: np.ndarray) -> list[int]:
    """The places of a large bucket's first member and of its first of middling size: near copies share their large buckets, and in most of them these two. A small one has none."""
    if len(nodes) <= BUCKET:
        return []
    low, high = np.percentile(n, [40, 60], method="nearest")
    return list({0: None, int(((n >= low) & (n <= high)).argmax()): None})


def spans_of(keys: np.ndarray):
    """First place and size of each bucket of rows sorted by key."""
    _, starts, sizes = np.unique(keys, return_index=True, return_counts=True)
    return zip(starts.tolist(), sizes.tolist())


def first_pairs(keys: np.ndarray, nodes: np.ndarray, n: np.ndarray, at: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Of rows sorted by key: the pairs of each large bucket's leaders with its members that may be alike."""
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for s, k in spans_of(keys):
        of, size, place = nodes[s : s + k], n[s : s + k], at[s : s + k]
        for i in leaders(of, size):
            hit = may_be_alike(size[i], place[i], size, place, similarity)
            a.append(np.full(hit.sum(), of[i]))
            b.append(of[hit])
    return np.concatenate(a), np.concatenate(b)


def other_pairs(keys: np.ndarray, nodes: np.ndarray, n: np.ndarray, at: np.ndarray, roots: np.ndarray, similarity: float, sketches: np.ndarray | None = None, low: int = 0, high: int | None = None):
    """Of rows sorted by key: the other pairs of a bucket that may be alike and don't have the same root, in parts.

    In a large bucket, those whose former one is from place low up to high of its members less the leaders; small buckets are looked at when low is 0. With sketches, these must allow it too.
    """

    def fit(i, j):
        hit = (roots[i] != roots[j]) & may_be_alike(n[i], at[i], n[j], at[j], similarity)
        if sketches is not None and hit.any():
            i, j = i if np.isscalar(i) else i[hit], j[hit]
            apart = np.bitwise_count((sketches[i] ^ sketches[j]).view(np.uint64)).sum(axis=1, dtype=np.int64)  # of signed numbers it counts the absolute value's bits
            hit[hit] = apart * (1 + similarity) <= (1 - similarity) * (n[i] + n[j]) + SLACK
        return hit

    if low == 0:
        _, place_of, size = np.unique(keys, return_inverse=True, return_counts=True)
        few = np.flatnonzero(size[place_of] <= BUCKET)
        for d in range(1, BUCKET):  # small buckets all at once, by how far their rows lie apart
            same = np.flatnonzero(keys[few[d:]] == keys[few[:-d]])
            if not len(same):
                break
            i, j = few[same], few[same + d]
            hit = fit(i, j)
            yield nodes[i[hit]], nodes[j[hit]]
    for s, k in spans_of(keys):
        if k <= BUCKET:
            continue
        done = np.zeros(k, bool)
        done[leaders(nodes[s : s + k], n[s : s + k])] = True  # these have met all members
        rest = np.flatnonzero(~done) + s
        end = len(rest) if high is None else min(high, len(rest))
        if low >= end:
            continue
        kinds, kind, count = np.unique(roots[rest], return_inverse=True, return_counts=True)
        if len(kinds) == 1:
            continue
        outside = kind != count.argmax()  # members of the largest group are looked at from the others only
        for place in np.flatnonzero(outside).tolist():
            former = np.arange(low, min(place, end))
            met = rest[former[~outside[former]]] if len(former) else rest[:0]  # others look at this one themselves
            if low <= place < end:
                met = np.concatenate([met, rest[place + 1 :]])
            if len(met) and (hit := fit(int(rest[place]), met)).any():
                yield np.full(hit.sum(), nodes[rest[place]]), nodes[met[hit]]


def gathered(parts, most: int = 1 << 16):
    """Pairs (two arrays each) put together until there are so many."""
    held, n = [], 0
    for part in parts:
        held.append(part)
        n += len(part[0])
        if n >= most:
            yield tuple(map(np.concatenate, zip(*held)))
            held, n = [], 0
    if n:
        yield tuple(map(np.concatenate, zip(*held)))


def array_of(column: pa.Array) -> np.ndarray:
    """A column of numbers; lists, all of one length, give a row each."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if pa.types.is_list(column.type) and len(column) else column.to_numpy(zero_copy_only=False)


def buckets(batches, columns: list[str]):
    """Arrays of the columns, key first, of whole buckets from batches sorted by key. Parts of one that goes on are put together once."""
    held: list = []
    for batch in batches:
        now = [array_of(batch.column(c)) for c in columns]
        if not len(now[0]):
            continue
        if held and now[0][0] == now[0][-1] == held[-1][0][-1]:
            held.append(now)
            continue
        cut = int(np.searchsorted(now[0], now[0][-1]))  # the last bucket may go on in the next batch
        if not held or cut or now[0][0] != held[-1][0][-1]:
            whole = [*held, [x[:cut] for x in now]]
            yield [np.concatenate(x) for x in zip(*whole)]
            held = []
        held.append([x[cut:] for x in now])
    if held:
        yield [np.concatenate(x) for x in zip(*held)]


def as_pairs(a: np.ndarray, b: np.ndarray):
    """a, b: the smaller and the larger node of different ones, once each, as a batch of rows."""
    both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)])[:, a != b], axis=1)
    return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])


def common_shingles(texts: DataFrame, width: int) -> np.ndarray:
    """Hashes (sorted) of shingles that many texts (text, text_hash) have, by a look at a part of them. What is common only settles an order."""

    def of(batches):
        for batch in batches:
            for t in batch.column("text").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(t, width).view(np.int64))], names=["h"])

    part = texts.where(F.pmod("text_hash", F.lit(COMMON_OF)) == 0).dropDuplicates(["text_hash"])
    least = max(LEAST_COMMON, part.select("text_hash").count() // COMMON_SHARE)
    counted = part.select("text").mapInArrow(tidy(of), "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    return np.sort(np.array([r.h for r in counted.select("h").collect()], np.int64).view(np.uint64))


def near_copies(docs: DataFrame, width: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, text_hash, component_id: the smallest id in the group of texts alike to this degree, taken transitively.

    Two texts are alike if their sets of shingles have this Jaccard similarity or more; every such pair is found, and no other linked.
    text_hash tells apart rows of one id. Texts without words (null ones too) are alike. Null ids come last; repeated rows come repeated. An empty table gives an empty result.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.withColumn("text_hash", F.xxhash64("text"))
    common = docs.sparkSession.sparkContext.broadcast(common_shingles(texts, width))

    @F.pandas_udf("node long, also long, fp long, n int, prefix array<long>, sketch array<long>")
    def sets(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from tidy(lambda texts: map(of_texts, texts))(batches)

    def of_texts(texts: pd.Series) -> pd.DataFrame:
        whole = [run_of_words(t, width) for t in texts]
        found = list(map(np.unique, whole))
        prefixes = [prefix_of(h, common.value, similarity).view(np.int64) for h in found]
        ids = lambda seed: np.array([xxhash.xxh3_64_intdigest(h.tobytes(), seed) for h in found], np.uint64).view(np.int64)
        return pd.DataFrame({"node": ids(0), "also": ids(1), "fp": [fingerprint_of(h) for h in whole], "n": [len(h) for h in found], "prefix": prefixes, "sketch": [sketch_of(h) for h in found]})

    rows = keep(texts.select("doc_id", "text_hash", sets("text").alias("s")).select("doc_id", "text_hash", "s.*"), "copies-rows")
    # of sets that share a node by chance all but the first get another
    clash = rows.groupBy("node").agg(F.min("also").alias("first"), F.max("also").alias("last")).where("first <> last").drop("last")
    if not clash.isEmpty():
        apart = F.when(F.col("also") != F.col("first"), F.xxhash64("node", "also")).otherwise(F.col("node"))
        rows = keep(rows.join(clash, "node", "left").withColumn("node", apart).select(rows.columns), "copies-rows-apart")
    one = F.min(F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("order"), "doc_id", "text_hash")).alias("one")
    alike_in_all = (F.first(c).alias(c) for c in ("n", "sketch"))
    nodes = keep(rows.groupBy("node").agg(one, F.min("fp").alias("fp"), *alike_in_all).select("node", "fp", "one.doc_id", "one.text_hash", "n", "sketch"), "copies-nodes")
    by_fp = keep(nodes.groupBy("fp").agg(F.min("node").alias("a")), "copies-fingerprints")
    # whatever fingerprints link is compared with one of its component: as many pairs as nodes, however large a group is
    linked = by_fp.join(components(links(by_fp.select("fp"))).withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    linked = linked.join(linked.groupBy("root").agg(F.min("a").alias("b")), "root").select("fp", "b")
    near = nodes.join(linked, "fp").where(F.col("node") != F.col("b")).select(F.col("node").alias("a"), "b")
    near = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))

    keyed = rows.select("node", "n", F.posexplode("prefix").alias("at", "key")).select("key", "node", "n", "at")
    columns = ["key", "node", "n", "at"]

    def shared(batches):
        for whole in buckets(batches, columns):
            new = np.concatenate([[True], (whole[0][1:] != whole[0][:-1]) | (whole[1][1:] != whole[1][:-1])])  # rows of one set come once
            whole = [x[new] for x in whole]
            _, at, size = np.unique(whole[0], return_inverse=True, return_counts=True)
            many = size[at] > 1
            yield pa.RecordBatch.from_arrays([pa.array(x[many]) for x in (*whole, size[at])], names=[*columns, "size"])

    met = keep(keyed.repartition("key").sortWithinPartitions("key", "node").mapInArrow(tidy(shared), "key long, node long, n int, at int, size long"), "copies-met")

    # the fewer of its first shingles are its own alone, the more typical a text is of those that it shares the others with: one order for all keys
    own = met.groupBy("node").agg((F.first("n") - F.ceil(similarity * F.first("n") - SLACK) + 1 - F.count(F.lit(1))).alias("own"))
    columns.append("own")
    ranked = keep(met.join(own, "node").select(*columns, "size"), "copies-ranked")

    def first(batches):
        for key, node, n, at, _ in buckets(batches, columns):
            yield as_pairs(*first_pairs(key, node, n.astype(np.int64), at.astype(np.int64), similarity))

    def others(low: int, high: int):
        def of(batches):
            whole = buckets(batches, [*columns, "root", "sketch"])
            found = (other_pairs(key, node, n.astype(np.int64), at.astype(np.int64), root, similarity, sketch, low, high) for key, node, n, at, _, root, sketch in whole)
            for a, b in gathered(chain.from_iterable(found)):
                yield as_pairs(a, b)

        return tidy(of)

    def packed(batches):
        seen: set[int] = set()  # repeated rows of one id come once
        for batch in batches:
            got = {n: t for n, t in zip(batch.column("node").to_pylist(), batch.column("text").to_pylist()) if n not in seen}
            seen |= got.keys()
            yield pa.RecordBatch.from_arrays([pa.array(list(got), pa.int64()), pa.array([zlib.compress(t.encode()) for t in got.values()], pa.binary())], names=["node", "packed"])

    @F.pandas_udf("boolean")
    def alike(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        yield from tidy(lambda pairs: (verdicts(*pair) for pair in pairs))(batches)

    def verdicts(x: pd.Series, y: pd.Series) -> pd.Series:
        of, out = lru_cache(256)(lambda z: shingle_set(zlib.decompress(z).decode(), width)), []
        for p, q in zip(map(of, x), map(of, y)):
            both = len(np.intersect1d(p, q, assume_unique=True))
            out.append(both >= similarity * (len(p) + len(q) - both) - SLACK)
        return pd.Series(out, dtype=bool)

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition("key").sortWithinPartitions("key", "own", "node")

    def sketched(pairs: DataFrame) -> DataFrame:
        """Those of the pairs whose sketches aren't too far apart; the others need no texts."""
        of = lambda c, n, sketch: nodes.select(F.col("node").alias(c), F.col("n").alias(n), F.col("sketch").alias(sketch))
        pairs = pairs.distinct().join(of("a", "n", "x"), "a").join(of("b", "m", "y"), "b")
        return pairs.where(sketches_allow(F.col("n"), F.col("x"), F.col("m"), F.col("y"), similarity)).select("a", "b")

    def links_of(pairs: DataFrame, name: str) -> DataFrame:
        """Those of the pairs that are alike, by the whole texts of their nodes."""
        pairs = keep(pairs, f"copies-{name}-pairs")
        wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        wanted = nodes.join(wanted, "node", "left_semi").select("node", F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
        found = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")))
        known = keep(found.select("node", "text").mapInArrow(tidy(packed), "node long, packed binary"), f"copies-{name}-texts")
        joined = pairs.join(known.select(F.col("node").alias("b"), F.col("packed").alias("y")), "b").join(known.select(F.col("node").alias("a"), F.col("packed").alias("x")), "a")
        out = keep(joined.where(alike("x", "y")).select("a", "b"), f"copies-{name}-links")
        discard(pairs, known)
        return out

    large = ranked.where(F.col("size") > BUCKET).select(columns)
    found = [links_of(sketched(dealt(large).mapInArrow(tidy(first), "a long, b long").unionByName(near)), "first")]
    left, rooted, low, high = ranked.drop("size"), None, 0, STRETCH
    while True:
        roots = components(reduce(DataFrame.unionByName, found))
        before, rooted = rooted, keep(left.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).select(*columns, "root"), "copies-rooted")
        if before is not None:
            discard(before)
        by_key = rooted.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.count(F.lit(1)).alias("size"))
        mixed = by_key.where("least <> most").where((F.lit(low) == 0) | (F.col("size") > max(low, BUCKET))).select("key")
        left = rooted.join(mixed, "key", "left_semi")
        if left.isEmpty():
            break
        met_now = dealt(left.join(nodes.select("node", "sketch"), "node").select(*columns, "root", "sketch"))
        found.append(links_of(met_now.mapInArrow(others(low, high), "a long, b long").distinct(), "other"))
        left, low, high = left.drop("root"), high, high * STRETCH
    placed = nodes.select("node", F.col("doc_id").alias("first")).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    out = keep(rows.select("doc_id", "text_hash", "node").join(placed.join(least, "root").select("node", "component_id"), "node").select("doc_id", "text_hash", "component_id"), "copies")
    discard(rows, nodes, by_fp, met, ranked, rooted, *found)
    return out


def drop_near_copies(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """docs (with doc_id and text) less all but one of each group of near copies: that with the smallest id, and of equal ids the smallest hash of the text. Rows alike in both are one. Columns stay as they are."""
    docs = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    groups = near_copies(docs, width, similarity)
    one = groups.groupBy("component_id").agg(F.min(F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)), "doc_id", "text_hash")).alias("one"))
    one = one.select(F.col("one.doc_id").alias("_id"), F.col("one.text_hash").alias("_hash"))
    rows = docs.select("row", F.col("doc_id").cast("long").alias("_of"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("_text"))
    rows = rows.join(one, F.col("_of").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash")), "left_semi")
    first = F.row_number().over(Window.partitionBy("_of", "_text").orderBy(F.xxhash64("row")))
    return rows.withColumn("_nth", first).where("_nth = 1").select("row.*")
