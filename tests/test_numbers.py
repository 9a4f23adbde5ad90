import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from signalloom.functions.numbers import fixed_exact, round_exact


def doubles(seed, n):
    draw = random.Random(seed)
    out = [0.0, -0.0, 0.005, 0.015, 0.025, 0.125, 0.375, 2.675, 1.005, 0.5, 1.5, 2.5, -0.5, -2.5, 1e-320, 5e-324, 0.0049999999999999999, 0.00499999999999999, 123456789.125, 2.0**51 + 0.5, -(2.0**40) - 0.125, 0.1 + 0.2, 99.995, 1.0, 1024.0, 1 - 2**-53, 1 + 2**-52]
    out += [draw.uniform(0, 100) for _ in range(n)] + [round(draw.uniform(-1000, 1000), 3) for _ in range(n)] + [draw.randint(-(10**6), 10**6) / 8 for _ in range(n)]
    out += [draw.uniform(-1, 1) * 10.0 ** draw.randint(-12, 12) for _ in range(n)] + [math.nextafter(draw.randint(1, 10**5) / 1000 + 0.0005, draw.choice([0, 1e9])) for _ in range(n)]
    return out + [2.0**k for k in range(-70, 50)] + [math.nextafter(2.0**k, 0) for k in range(-70, 50)]


@pytest.mark.parametrize("digits", [0, 1, 2, 3, 6])
def test_equal_to_python(spark, digits):
    df = spark.createDataFrame([(x,) for x in doubles(digits, 1500)], "x double")
    rows = df.select("x", round_exact(F.col("x"), digits).alias("r"), fixed_exact(F.col("x"), digits).alias("t")).collect()
    assert [(r.x, r.r, r.t) for r in rows if r.r != round(r.x, digits) or r.t != f"{r.x:.{digits}f}"] == []


def test_any_bits(spark):
    draw = random.Random(9)
    found = [struct.unpack("d", struct.pack("Q", draw.getrandbits(64)))[0] for _ in range(3000)] + [float(2**53 + 2 * i) for i in range(9)] + [1e18, 9e15, 4503599627370497.5, -4503599627370495.5]
    rows = spark.createDataFrame([(x,) for x in found], "x double").select("x", round_exact(F.col("x"), 2).alias("r"), fixed_exact(F.col("x"), 2).alias("t")).collect()
    for r in rows:
        if math.isnan(r.x):
            assert math.isnan(r.r) and r.t == "nan"
        elif math.isinf(r.x) or abs(r.x) >= 1e37:
            assert r.r == r.x
        else:
            assert r.r == round(r.x, 2) and (abs(r.x) >= 2**63 or r.t == f"{r.x:.2f}"), r


def test_what_has_no_places(spark):
    df = spark.createDataFrame([(None,), (float("inf"),), (float("-inf"),), (float("nan"),)], "x double")
    rows = df.select(round_exact(F.col("x"), 2).alias("r"), fixed_exact(F.col("x"), 2).alias("t")).collect()
    assert [r.t for r in rows] == [None, "inf", "-inf", "nan"] and rows[0].r is None and rows[1].r == float("inf")
    with pytest.raises(ValueError):
        round_exact(F.col("x"), 16)
