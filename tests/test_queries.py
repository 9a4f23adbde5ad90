"""Every query against its SQL, over the driver's smallest tables."""

import math
import os

import duckdb
import pytest

from signalloom.plans import registry

SF = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return v.replace(tzinfo=None).isoformat() if hasattr(v, "isoformat") else v


def rows(columns, records):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in records), key=repr)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", list(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    got = rows(df.columns, df.collect())
    assert got
    if sql := registry.oracle_sql().get(name):
        want = duck.execute(sql)
        columns = [d[0] for d in want.description]
        assert sorted(columns) == sorted(df.columns)
        want = rows(columns, want.fetchall())
        assert len(got) == len(want)
        different = [(g, w) for g, w in zip(got, want) if g != w]
        assert not different, different[:3]
