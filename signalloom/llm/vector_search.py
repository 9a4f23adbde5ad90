"""Exact top-k search by columnar branch-and-bound.

Candidates are dealt into tiles, which hold them dimension by dimension. For each query a tile's scores grow by one
block of dimensions at a time; after each block the candidates go whose score so far, plus the most that the remaining
dimensions can add (the product of the remaining norms), stays below the k-th best so far. Queries are dealt into blocks, so
each task holds one block of queries and one tile. Both are dealt by hash into as many as a count asks for, so neither depends on which ids
there are. Python is needed since which candidates are left decides the next step.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalloom.llm.common import keep

#: Queries and candidates that meet in one task at most, and dimensions that are added at a time.
QUERY_BLOCK, TILE, DIMS = 4096, 32768, 16


def tail_norms(rows: np.ndarray) -> np.ndarray:
    """[i, b]: the norm of row i from dimension b * DIMS on."""
    squares = np.cumsum((rows.astype(np.float64) ** 2)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.concatenate([squares[:, ::DIMS], np.zeros((len(rows), 1))], axis=1))


def best_in_tile(q_ids, q_of, queries, ids, of, rows, times, k):
    """For each query (id, hash of its vector, vector) its k best of a tile of different rows, which occur so many times: yields ids, scores and times, ties to smaller ids. Of rows like the query in id and vector one is its own."""
    order = np.argsort(ids, kind="stable")
    ids, of, rows, times = ids[order], of[order], rows[order], times[order]
    across, tails, q_tails = np.ascontiguousarray(rows.T), tail_norms(rows), tail_norms(queries)
    for qid, hashed, q, q_tail in zip(q_ids, q_of, queries, q_tails):
        here = slice(*np.searchsorted(ids, [qid, qid + 1]))
        count = times
        if (own := (of[here] == hashed) & (rows[here] == q).all(axis=1)).any():
            count = times.copy()
            count[here] -= own
        left = np.flatnonzero(count > 0)
        score = np.zeros(len(left), np.int64)
        for b, d in enumerate(range(0, len(q), DIMS)):
            score += q[d : d + DIMS] @ across[d : d + DIMS, left]
            if len(left) > k and d + DIMS < len(q):
                room = np.ceil(q_tail[b + 1] * tails[left, b + 1] * (1 + 1e-9)).astype(np.int64)
                least = np.partition(score - room, len(left) - k)[len(left) - k]  # k candidates are sure to get at least this
                stay = score + room >= least
                left, score = left[stay], score[stay]
        top = np.lexsort((ids[left], -score))[:k]
        yield ids[left[top]], score[top], np.minimum(count[left[top]], k)


def square(vectors) -> np.ndarray:
    """Vectors as rows; those that are shorter than others go on with zeros."""
    width = max(map(len, vectors), default=0)
    return np.array([np.pad(np.asarray(v, np.int64), (0, width - len(v))) for v in vectors], np.int64).reshape(len(vectors), width)


def top_k(vectors: DataFrame, every: int, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k rows with the highest integer inner product for each row whose id is divisible by `every`, among all rows but its own.

    Components become floor(scale * x), x as double. Result: query_id, rank (from 1), vec_id, score; ties go to the
    smaller id, and a query with fewer than k others gets them all. Rows with a null id, a null vector, or a null or
    non-finite component take no part. Of a repeated id every row counts: each as a candidate of all others, each, if it is asked for, with a list of its own.
    Rows alike in id and vector are held once, with their number. Vectors may differ in length: missing components count as 0. An empty table gives an empty result; other columns are ignored.
    """
    whole = F.transform(F.col(vector_col), lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    fine = F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).where(fine).select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("v"))
    # of rows that are alike in id and vector one is held, and looked up, for all of them
    rows = keep(rows.groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("times")).withColumn("of", F.xxhash64("v", F.size("v"))), "vectors")
    asked = rows.where(F.col("vec_id") % every == 0)
    number = lambda n: F.pmod(F.xxhash64("vec_id", "v"), F.lit(n))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    size = rows.count()
    tiles = max(1, -(-size // TILE), min(vectors.sparkSession.sparkContext.defaultParallelism, size // 1024))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))
    across = rows.withColumn("tile", number(tiles)).withColumn("block", each(blocks))
    asked = asked.withColumn("block", number(blocks)).withColumn("tile", each(tiles))

    def search(queries: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        out: list = [(np.zeros(0, np.int64),) * 6]
        if len(queries) and len(found):
            both = square([*queries.v, *found.v])
            ids = queries.vec_id.to_numpy()
            best = best_in_tile(ids, queries["of"].to_numpy(), both[: len(ids)], found.vec_id.to_numpy(), found["of"].to_numpy(), both[len(ids) :], found.times.to_numpy(), k)
            for qid, of, times, (near, scores, counts) in zip(ids, queries["of"], queries.times, best):
                out.append((np.full(len(near), qid), np.full(len(near), of), np.full(len(near), times), near, scores, counts))
        return pd.DataFrame(dict(zip(("query_id", "of", "times", "vec_id", "score", "count"), map(np.concatenate, zip(*out)))))

    schema = "query_id long, of long, times long, vec_id long, score long, count long"
    parts = asked.groupBy("block", "tile").cogroup(across.groupBy("block", "tile")).applyInPandas(search, schema)
    each_time = lambda n: F.explode(F.sequence(F.lit(1).cast("long"), F.col(n)))
    parts = parts.withColumn("which", each_time("count"))
    best = Window.partitionBy("query_id", "of").orderBy(F.desc("score"), "vec_id")
    found = parts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score", each_time("times").alias("again")).drop("again")
