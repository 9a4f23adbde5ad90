"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies cover all training documents. The weights are learnt on a bounded sample of them, by
follow-the-regularised-leader with an elastic-net penalty, which leaves most weights zero; a part of the sample that they
don't see sets the temperature by which the scores are calibrated. Every text is then labelled whole, where it lies.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalloom.llm.common import id_crc_mod, tidy

#: Lengths of the n-grams, and the number of buckets (as a power of two) that they are hashed to.
ORDERS, BUCKET_BITS = (1, 2, 3), 15
#: Labelled documents that the weights are learnt on, shared out evenly among languages; the driver holds no more than twice as many.
SAMPLE = 3000
EPOCHS, ALPHA, BETA, L1, L2 = 4, 0.5, 1.0, 0.02, 0.002
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text's character n-grams and 1 + log of how often each occurs."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32).astype(np.uint64)
    h, parts = np.zeros(len(points), np.uint64), []
    with np.errstate(over="ignore"):
        for order in range(1, max(ORDERS) + 1):
            h = h[: len(points) - order + 1] * np.uint64(0x100000001B3) + points[order - 1 :] + np.uint64(1)
            if order in ORDERS:
                parts.append(((h + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
            if len(h) == 0:
                break
    counts = np.bincount(np.concatenate(parts), minlength=1 << BUCKET_BITS)
    at = np.flatnonzero(counts)
    return at, 1 + np.log(counts[at])


def weighed(at: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = tf * idf[at]
    return x / (math.sqrt(float(x @ x)) or 1.0)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


class FtrlProximal:
    """Multinomial logistic regression; weights are a function of summed gradients (z) and their squares (n)."""

    def __init__(self, features: int, classes: int):
        self.z, self.n = np.zeros((features, classes)), np.zeros((features, classes))

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) > L1, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = softmax(x @ w)
        p[label] -= 1
        g = x[:, None] * p[None, :]
        now = self.n[at]
        self.z[at] += g - (np.sqrt(now + g * g) - np.sqrt(now)) / ALPHA * w
        self.n[at] = now + g * g


def temperature(logits: list[np.ndarray], labels: list[int]) -> float:
    """The temperature under which the labels are likeliest, if one more of them than is seen were wrong (without that, labels that are all right would ask for certainty)."""
    if not logits or len(logits[0]) < 2:
        return 1.0
    z, y = np.array(logits), np.array(labels)
    wrong = 1 / (len(y) + 2)
    wanted = np.full(z.shape, wrong / (z.shape[1] - 1))
    wanted[np.arange(len(y)), y] = 1 - wrong

    def loss(t: float) -> float:
        s = z / t
        s -= s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - (wanted * s).sum(axis=1)).mean())

    return min(np.exp(np.linspace(math.log(0.02), math.log(20), 200)).tolist(), key=loss)


def is_held_out(doc_id: Column) -> Column:
    return id_crc_mod(doc_id, 3) == 1


def train(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict:
    """The model: langs, idf, weights, temperature. It learns from text and lang of rows that aren't held out and have both."""
    rows = docs.where(~is_held_out(F.col(id_col)) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes)

    def frequencies(batches):
        df, n = np.zeros(1 << BUCKET_BITS, np.int64), 0
        for batch in batches:
            for text in batch.text:
                if text:
                    df[grams(text)[0]] += 1
                    n += 1
        at = np.flatnonzero(df)
        yield pd.DataFrame({"bucket": np.append(at, -1), "n": np.append(df[at], n)})

    df = {r.bucket: r.n for r in rows.select("text").mapInPandas(tidy(frequencies), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    total = df.pop(-1, 0)
    idf = np.full(1 << BUCKET_BITS, math.log(1 + total) + 1)
    for b, n in df.items():
        idf[b] = math.log((1 + total) / (1 + n)) + 1

    each = -(-sample // max(1, len(langs)))
    draw = F.shiftrightunsigned(F.xxhash64("id", F.lit(5)), 11) / F.lit(float(1 << 53))
    share = F.lit(0.0)
    for lang in langs:
        share = F.when(F.col("lang") == lang, min(1.0, each / sizes[lang])).otherwise(share)

    @F.pandas_udf("at array<int>, tf array<float>")
    def features(texts: pd.Series) -> pd.DataFrame:
        got = [grams(t) if t else (np.zeros(0, np.int64), np.zeros(0)) for t in texts]
        return pd.DataFrame({"at": [a.astype(np.int32) for a, _ in got], "tf": [f.astype(np.float32) for _, f in got]})

    picked = rows.where(draw < share).orderBy(draw, F.xxhash64("id", "text", "lang")).limit(2 * sample).select(F.xxhash64("id", "text").alias("order"), "lang", features("text").alias("f")).collect()
    label = {lang: i for i, lang in enumerate(langs)}
    picked = [(label[r.lang], np.array(r.f["at"], np.int64), np.array(r.f["tf"])) for r in sorted(picked, key=lambda r: (r.order, r.lang))]
    picked = [(y, at, weighed(at, tf, idf)) for y, at, tf in picked if len(at)]
    learner, aside = FtrlProximal(1 << BUCKET_BITS, len(langs)), picked[::5]
    seen = [p for i, p in enumerate(picked) if i % 5] or picked
    for _ in range(EPOCHS):
        for y, at, x in seen:
            learner.learn(at, x, y)
    weights = learner.weights(slice(None))
    return {"langs": langs, "idf": idf, "weights": weights.astype(np.float32), "temperature": temperature([x @ weights[at] for _, at, x in aside], [y for y, _, _ in aside])}


def predict(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """docs with lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets times languages

    @F.pandas_udf("lang_pred string, score double")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from tidy(lambda of: map(labels, of))(batches)

    def labels(texts: pd.Series) -> pd.DataFrame:
        m, out = shared.value, []
        for t in texts:
            if not t or not m["langs"] or not LETTER.search(t):
                out.append((UNKNOWN, 0.0))
                continue
            at, tf = grams(t)
            p = softmax(weighed(at, tf, m["idf"]) @ m["weights"][at] / m["temperature"])
            best = int(p.argmax())
            out.append((m["langs"][best], float(p[best])))
        return pd.DataFrame(out, columns=["lang_pred", "score"])

    return docs.withColumn("_label", label(F.col(text_col))).select(*(F.col(f"`{c}`") for c in docs.columns), "_label.lang_pred", "_label.score")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per input row: doc_id, held_out (crc32 of the id as text, modulo 3, is 1), lang_pred, score (0 to 1).

    Learns from rows that aren't held out. lang_pred is a lang value of theirs; it is `und`, with score 0, for a null text,
    one without letters, and any text if there is nothing to learn from. A null id counts as the empty text for the fold, and
    rows with a null lang teach nothing. Texts of any length count whole. Repeated rows come repeated. An empty table gives an empty
    result; other columns are ignored.
    """
    model = train(docs, id_col=id_col, text_col=text_col, lang_col=lang_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), is_held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    return predict(rows, model).select("doc_id", "held_out", "lang_pred", "score")


def only_known(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """docs (with doc_id, text, lang) less those whose language is `und` or less sure than `least`; its columns stay as they are.

    Null and empty texts, and those without letters, are `und` and go. Rows alike in text are judged alike, whatever their ids, so repeated rows stay or go
    together. Null ids and labels are no error: a row without a label teaches nothing. An empty table gives an empty result.
    """
    labelled = predict(docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("text").alias("text")), train(docs))
    return labelled.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select("row.*")
