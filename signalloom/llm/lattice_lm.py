"""Language-model scores by subword lattice likelihood.

A word, its start marked, is a lattice whose arcs are pieces of a given vocabulary; the model gives it the probability of all paths
together, by forward recursion in log space, and a text the product of its words' and its end's. Each arc weighs by its
piece's unigram score, whatever the word: the vocabulary's own scores are the prior, and training text adds how often it has
each piece (its distinct words, weighed by how often they occur, over all their segmentations: ROUNDS rounds of
expectation, from the prior alone on). A word's
probability depends on the word alone, so it is worked out once for each distinct word of the corpus, not for each place where it stands.

Documents stay where they are read. They are laid out in chunks: rows with the chunk's distinct words and each
document's words as numbers. Chunks' words meet their counts and probabilities in a join by word, and come back by chunk and number; no
text is shuffled, and no task needs more of the corpus's vocabulary than its own chunk has.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalloom.llm.common import discard, id_crc_mod, keep, one_model

#: Bytes of text that fill a chunk; a document isn't split.
CHUNK = 8 << 20
#: What the prior adds to the pieces' counts, as a mean over pieces.
PRIOR = 0.5
#: Times that counts of pieces are worked out anew, over all segmentations.
ROUNDS = 4
#: Letters of words whose lattices are held at once (some 200 bytes a letter; a longer word is held whole), and the unit of expected counts, whole numbers of which add up alike in any order.
LETTERS, UNIT = 1 << 17, 1 << 16
#: Words of which one task works out the probability.
WORDS = 50_000
MARK = "▁"
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
BLANK = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Of texts (strings, none null): their distinct words, lower-cased from A to Z, as bytes; each place's word, by number; and how many words each text has."""
    texts = texts.cast(pa.large_binary())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    solid = ~BLANK[data]
    new = solid.copy()
    new[1:] &= ~solid[:-1]
    first = bounds[:-1][bounds[:-1] < bounds[1:]]
    new[first] = solid[first]
    at, upto = np.flatnonzero(new), np.cumsum(solid, dtype=np.int64)
    offsets = np.append(upto[at] - 1, upto[-1] if len(upto) else 0)
    words = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(LOWER[data][solid])]).dictionary_encode()
    return words.dictionary.cast(pa.binary()), words.indices.to_numpy(), np.diff(np.searchsorted(at, bounds))


class Vocabulary:
    """Ids of pieces that stand for text, by piece; ids of the 256 byte pieces; the prior of each id, 1 in sum.

    A file's scores are logarithms of probabilities, or, if it was made by merging, the merges' ranks with a minus; then a piece of rank r
    has a prior in proportion to 1 / (r + 1). Bytes, and pieces without a rank of their own, have that of the last rank.
    """

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.whole = {sp.id_to_piece(i): i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}
        self.of_byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        scores = np.array([sp.get_score(i) for i in range(n)])
        ids = sorted(self.whole.values())
        ranks = bool((scores == np.round(scores)).all() and len(np.unique(scores[ids])) > 1)
        prior = np.maximum(1 / (1 - scores), 1 / (n + 1)) if ranks else np.exp(scores)
        text = np.zeros(n, bool)
        text[ids] = text[self.of_byte] = True
        prior[self.of_byte] = prior[ids].min() if ids else 1.0
        self.prior = np.where(text, prior, 0.0) / prior[text].sum()
        # a tree of the pieces' beginnings, and its steps as one sorted list of (node, code)
        nodes, steps, piece_at = {"": 0}, {}, [-1]
        for piece, i in self.whole.items():
            for k, letter in enumerate(piece):
                if piece[: k + 1] not in nodes:
                    steps[nodes[piece[:k]] << 21 | ord(letter)] = nodes[piece[: k + 1]] = len(nodes)
                    piece_at.append(-1)
            piece_at[nodes[piece]] = i
        self.piece_at, self.steps = np.array(piece_at), np.array(sorted(steps), np.int64)
        self.into = np.array([steps[s] for s in self.steps.tolist()], np.int64)

    def step(self, node: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The nodes that codes lead to from nodes; -1 if there is none."""
        key = node << 21 | code
        at = np.minimum(np.searchsorted(self.steps, key), len(self.steps) - 1)
        return np.where(self.steps[at] == key, self.into[at], -1)

    def bytes_of(self, code: int) -> list[int]:
        return [self.of_byte[b] for b in chr(code).encode("utf-8", "surrogatepass")]


def vocabulary(path: str) -> Vocabulary:
    return one_model(Vocabulary, path)


class Lattice:
    """log_weights: natural logarithms by piece id. Lattices of many words are worked out together, one place of all of them at a time."""

    def __init__(self, known: Vocabulary, log_weights: np.ndarray):
        self.known, self.log_weights = known, log_weights

    def log_probabilities(self, words: list[str]) -> np.ndarray:
        """Of all ways to make each word, its start marked, from pieces. A character that is no piece is made of its bytes."""
        return np.concatenate([np.zeros(0), *(lattice.forward()[lattice.last] for _, lattice in self._parts(words))])

    def expected(self, words: list[str], times: np.ndarray) -> np.ndarray:
        """How often words that occur so many times have each piece, by id: over all ways to make them, by their probability, in units of 1 / UNIT."""
        got = np.zeros(len(self.log_weights), np.int64)
        for at, lattice in self._parts(words):
            upto, behind = lattice.forward(), lattice.backward()
            share = np.exp(upto[lattice.start] + lattice.weight + behind[lattice.end] - upto[lattice.last][lattice.word])
            n = np.rint(share * times[at : at + len(lattice.last)][lattice.word] * UNIT).astype(np.int64)
            whole = lattice.piece >= 0
            np.add.at(got, lattice.piece[whole], n[whole])
            for code, of in zip(lattice.piece[~whole], n[~whole], strict=True):
                np.add.at(got, self.known.bytes_of(~int(code)), of)
        return got

    def _parts(self, words: list[str]) -> Iterator[tuple[int, Lattices]]:
        """Words in runs of some LETTERS letters: the first's number, and their lattices."""
        at = size = 0
        for i, w in enumerate(words):
            if size and size + len(w) > LETTERS:
                yield at, Lattices(self.known, self.log_weights, words[at:i])
                at, size = i, 0
            size += len(w) + 1
        if size:
            yield at, Lattices(self.known, self.log_weights, words[at:])


class Lattices:
    """Arcs of some words: word, the places that they start and end at, piece (of a character made of its bytes, its code's complement) and weight. A word has a place before each letter and one at its end."""

    def __init__(self, known: Vocabulary, log_weights: np.ndarray, words: list[str]):
        text = "".join([MARK + w for w in words])
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        of = np.repeat(np.arange(len(words)), sizes)
        upto = np.cumsum(sizes)[of]
        first, node, found, alone = np.arange(len(codes)), np.zeros(len(codes), np.int64), [], np.zeros(len(codes), bool)
        depth = 0
        while len(first):
            node = known.step(node, codes[first + depth])
            on = node >= 0
            first, node, depth = first[on], node[on], depth + 1
            piece = known.piece_at[node]
            ends = piece >= 0
            found.append((first[ends], first[ends] + depth, piece[ends]))
            if depth == 1:
                alone[first[ends]] = True
            on = first + depth < upto[first]
            first, node = first[on], node[on]
        bare = np.flatnonzero(~alone)
        start, end, self.piece = (np.concatenate(x) for x in zip(*found, (bare, bare + 1, ~codes[bare]), strict=True))
        self.word = of[start]
        self.start, self.end, self.last = start + self.word, end + self.word, np.cumsum(sizes + 1) - 1
        self.weight = np.empty(len(start))
        whole = self.piece >= 0
        self.weight[whole] = log_weights[self.piece[whole]]
        some, which = np.unique(self.piece[~whole], return_inverse=True)
        self.weight[~whole] = np.array([log_weights[known.bytes_of(~int(code))].sum() for code in some])[which]
        self.n, self.offsets = len(codes) + len(words), (np.cumsum(sizes + 1) - sizes - 1)[self.word]

    def forward(self) -> np.ndarray:
        """By place: the logarithm of the sum over ways from the word's start to it."""
        return self._summed(self.start, self.end, 1)

    def backward(self) -> np.ndarray:
        """By place: the logarithm of the sum over ways from it to the word's end."""
        return self._summed(self.end, self.start, -1)

    def _summed(self, source: np.ndarray, to: np.ndarray, way: int) -> np.ndarray:
        level = (to - self.offsets) * way
        order = np.lexsort((to, level))
        source, to, level, weight = source[order], to[order], level[order], self.weight[order]
        new = np.flatnonzero(np.diff(to, prepend=-1))
        places = to[new]
        levels = np.append(np.flatnonzero(np.diff(level[new], prepend=level[0] - 1)), len(new))
        bounds = np.append(new, len(to))
        out = np.zeros(self.n)
        for a, b in zip(levels[:-1], levels[1:], strict=True):
            lo, hi = bounds[a], bounds[b]
            ways, cuts = out[source[lo:hi]] + weight[lo:hi], bounds[a:b] - lo
            top = np.maximum.reduceat(ways, cuts)
            out[places[a:b]] = top + np.log(np.add.reduceat(np.exp(ways - np.repeat(top, np.diff(bounds[a : b + 1]))), cuts))
        return out


def laid_out(rows: DataFrame) -> DataFrame:
    """One row per chunk of rows (doc_id, text, held_out): chunk, words and counts (distinct words, and how often its training documents have them), ends (how many these are), doc_ids, held_out, sizes (words of each document), numbers (each place's word; packed)."""
    names = ["chunk", "words", "counts", "ends", "doc_ids", "held_out", "sizes", "numbers"]
    schema = "chunk long, words array<binary>, counts array<long>, ends long, doc_ids array<long>, held_out array<boolean>, sizes array<long>, numbers binary"

    def lay(batches):
        part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0

        def row():
            rows = pa.Table.from_batches(held).combine_chunks()
            words, numbers, sizes = words_of(rows.column("text").combine_chunks() if rows.num_rows else pa.array([], pa.string()))
            held_out = rows.column("held_out").to_numpy()
            counts = np.bincount(numbers[np.repeat(~held_out, sizes)], minlength=len(words))
            whole = [pa.array([part << 32 | seq]), one(words), one(pa.array(counts, pa.int64())), pa.array([int((~held_out).sum())]), one(rows.column("doc_id").combine_chunks()), one(pa.array(held_out)), one(pa.array(sizes, pa.int64()))]
            return pa.RecordBatch.from_arrays([*whole, pa.array([zstandard.ZstdCompressor(level=1).compress(numbers.astype("<i4"))], pa.binary())], names=names)

        def one(values):
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= CHUNK:
                yield row()
                held, size, seq = [], 0, seq + 1
        if size:
            yield row()

    return rows.mapInArrow(lay, schema)


def expected_counts(words: DataFrame, path: str, weights) -> dict[int, float]:
    """How often pieces occur in training text (word, c) on average, all segmentations of each word counted by their probability under the weights (a broadcast array). What comes to the driver is bounded by the vocabulary, a row a piece."""

    def expect(batches):
        lattice = Lattice(vocabulary(path), weights.value)
        got = np.zeros(len(weights.value), np.int64)
        for batch in batches:
            got += lattice.expected([w.decode(errors="replace") for w in batch.column("word").to_pylist()], batch.column("c").to_numpy())
        some = np.flatnonzero(got)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(got[some])], names=["piece", "n"])

    return {r.piece: r.n / UNIT for r in words.where("c > 0").mapInArrow(expect, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n")).collect()}


def unigram(known: Vocabulary, counts: dict[int, float], ends: int) -> tuple[np.ndarray, float]:
    """Log weights by piece id, and that of a text's end, which is a piece as well: counts and prior, over the sum of all."""
    weights = known.prior * PRIOR * np.count_nonzero(known.prior)
    for piece, times in counts.items():
        weights[piece] += times
    whole = weights.sum() + ends + PRIOR
    return np.log(np.where(weights > 0, weights, PRIOR) / whole), math.log((ends + PRIOR) / whole)


def score(docs: DataFrame, path: str, folds: int = 10, add: float = 0.1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score whole texts by what those whose crc32(id as text) mod `folds` isn't 0 teach.

    One row per input row: doc_id, held_out, n_tokens (words and one end), n_known (those among them that training
    documents have), train_tokens, base_score (unigram words with `add` added to each count), score (the lattice's log10
    probability). A null text is an empty one, whose only token is its end. A null id counts as the empty text for the
    fold. Repeated rows count each time. Words of any length are scored whole. An empty table gives an empty result;
    without training documents all counts are 0 and the prior alone weighs. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), (id_crc_mod(F.col(id_col), folds) == 0).alias("held_out"))
    chunks = keep(laid_out(rows), "lm-chunks")
    used = chunks.select(F.explode(F.arrays_zip("words", "counts")).alias("w")).select("w.words", "w.counts")
    words = keep(used.groupBy(F.col("words").alias("word")).agg(F.sum("counts").alias("c")), "lm-words")
    ends = chunks.agg(F.coalesce(F.sum("ends"), F.lit(0)).alias("n")).first().n
    of = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v"), F.count(F.lit(1)).alias("all")).first()
    n, v = of.n + ends, of.v + (ends > 0)

    known = Vocabulary(path)
    weights, end = unigram(known, {}, ends)
    parts = max(1, -(-of["all"] // WORDS))
    for _ in range(ROUNDS if of.v else 0):
        learnt = spark.sparkContext.broadcast(weights)  # as long as the vocabulary
        weights, end = unigram(known, expected_counts(words.repartition(parts), path, learnt), ends)
    learnt, end_score = spark.sparkContext.broadcast(weights), end / math.log(10)

    @F.pandas_udf("double")
    def log10_probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lattice = Lattice(vocabulary(path), learnt.value)
        for batch in batches:
            yield pd.Series(lattice.log_probabilities([w.decode(errors="replace") for w in batch]) / math.log(10))

    scored = keep(words.repartition(parts).select("word", "c", log10_probability("word").alias("p")), "lm-scored")
    discard(words)
    local = chunks.select(F.col("chunk").alias("of"), F.posexplode("words").alias("number", "word")).join(scored, "word").select("of", "number", "c", "p")

    def base(c):
        return np.log10((c + add) / (n + add * (v + 1)))

    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def score_chunk(documents: pa.Table, vocabulary: pa.Table) -> pa.Table:
        number = vocabulary.column("number").to_numpy()
        c, p = np.zeros(len(number), np.int64), np.zeros(len(number))
        c[number], p[number] = vocabulary.column("c").to_numpy(), vocabulary.column("p").to_numpy()
        out = []
        for row in documents.select(["doc_ids", "held_out", "sizes", "numbers"]).to_pylist():
            sizes = np.array(row["sizes"], np.int64)
            at = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["numbers"]), "<i4")
            doc = np.repeat(np.arange(len(sizes)), sizes)
            total = lambda x: np.bincount(doc, x[at], len(sizes))  # noqa: E731, B023
            n_known = total((c > 0).astype(np.float64)).astype(np.int64) + (ends > 0)
            columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(row["held_out"]), pa.array(sizes + 1), pa.array(n_known), pa.array(np.full(len(sizes), n)), pa.array(total(base(c)) + base(ends)), pa.array(total(p) + end_score)]
            out.append(pa.Table.from_arrays(columns, names))
        return pa.concat_tables(out)

    laid = chunks.select("chunk", "doc_ids", "held_out", "sizes", "numbers")
    scores = laid.groupBy("chunk").cogroup(local.groupBy("of")).applyInArrow(score_chunk, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    done = keep(scores, "lm")
    discard(chunks, scored)
    return done
