import os
import subprocess
import sys

import duckdb
import pytest

from signalloom.llm import queries as llm

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", list(llm.oracle_sql()))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = llm.queries()[name](spark, SF)
    want = con.execute(llm.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(d[0] for d in want.description)
    at = {d[0]: i for i, d in enumerate(want.description)}
    assert sorted(map(tuple, df.select(columns).collect()), key=repr) == sorted((tuple(r[at[c]] for c in columns) for r in want.fetchall()), key=repr)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_workers_need_no_path(tmp_path):
    """A driver elsewhere, with the package on its own path alone, can run Python functions."""
    code = f"""
import sys; sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as e
print("ROWS", e.queries()["op1_token_counts"](spark, {SF!r}).count(), len(e.queries()["op10_prefix_bpe"](spark, {SF!r}).collect()))
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 200 200" in said.stdout, said.stderr[-2000:]
