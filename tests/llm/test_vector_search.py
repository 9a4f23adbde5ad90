import math

import duckdb
import numpy as np

from signalloom.llm import vector_search
from signalloom.llm.queries import SQL
from signalloom.llm.vector_search import top_k

SCHEMA = "vec_id long, embedding array<float>, label int, score long"


def brute(rows, every, k):
    ok, out = [], []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ok.append((i, [math.floor(256 * float(np.float32(x))) for x in v]))
    for row, (q, v) in enumerate(ok):
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for other, (i, w) in enumerate(ok) if other != row)[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(scores, 1)]
    return sorted(out)


def run(spark, rows, every=10, k=5):
    return sorted(tuple(r) for r in top_k(spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA), every, k).collect())


def test_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=40) * (0.1 + i % 7)]) for i in range(400)]
    rows += [(i + 500, rows[5][1]) for i in range(30)]  # ties
    rows += [(20, rows[1][1]), (20, rows[2][1]), (20, rows[2][1]), (21, rows[3][1]), (21, rows[21][1]), (None, rows[4][1]), (1000, None), (1010, [None, 1.0]), (1020, [float("nan")]), (1030, [float("inf")]), (1040, []), (1050, [1.0])]
    assert run(spark, rows) == brute(rows, 10, 5)
    monkeypatch.setattr(vector_search, "QUERY_BLOCK", 7)
    monkeypatch.setattr(vector_search, "TILE", 60)
    assert run(spark, rows) == brute(rows, 10, 5)


def test_repeated_ids_agree_with_the_sql(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in rng.normal(size=8)]) for i in [50, 50, 1, 1, 2, 100, *rng.integers(0, 120, 60)]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    df.write.parquet(str(tmp_path / "e"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/e/*.parquet'")
    want = sorted(con.execute(f"SELECT query_id, rank, vec_id, score FROM ({SQL['op3_top_k']})").fetchall())
    assert sorted(tuple(r) for r in top_k(df, 50, 5).collect()) == want == brute(rows, 50, 5)


def test_a_row_repeated_often_is_held_once(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(30)] + [(40, [1.0, 0.0]), (40, [1.0]), (40, [1.0]), (10, [2.0])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)
    hot = spark.createDataFrame([(77, [3.0] * 8, 1, 2), (50, [3.0] * 8, 1, 2)], SCHEMA).crossJoin(spark.range(40_000)).drop("id")
    got = [tuple(r) for r in top_k(df.unionByName(hot), 10, 5).where("query_id <> 50").collect()]
    assert sorted(got) == [r for r in brute(rows + [(77, [3.0] * 8)] * 7 + [(50, [3.0] * 8)] * 7, 10, 5) if r[0] != 50]
    own = top_k(df.unionByName(hot), 50, 5).where("query_id = 50").groupBy("rank", "vec_id", "score").count().orderBy("rank").collect()
    assert [(r.rank, r.vec_id, r["count"]) for r in own] == [(i, 50, 40_000) for i in range(1, 6)]
    tile = np.array([[1, 2], [3, 4], [3, 4]])
    found = list(vector_search.best_in_tile(np.array([7]), np.array([2]), tile[1:2], np.array([9, 7, 7]), np.array([1, 2, 3]), tile, np.array([4, 1, 40_000]), 5))
    assert [x.tolist() for x in found[0]] == [[7, 9], [25, 11], [5, 4]]


def test_few_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(50, [1.0])]) == []
    assert run(spark, [(50, [1.0]), (7, [0.5])]) == [(50, 1, 7, 256 * 128)]
