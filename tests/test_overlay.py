import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from signalloom.operators.overlay import dealt, rollup


def brute(counts, overlay):
    weights = defaultdict(Counter)
    for cell, label, w in overlay:
        if w > 0:
            weights[cell][label] += w
    out = []
    for cell, n in counts:
        has = weights.get(cell)
        if not has:
            out.append((cell, None, n))
            continue
        total = sum(has.values())
        got = {label: n * w // total for label, w in has.items()}
        for label in sorted(has, key=lambda x: (-(n * has[x] % total), x))[: n - sum(got.values())]:
            got[label] += 1
        out += [(cell, label, k) for label, k in got.items()]
    return sorted(out, key=repr)


def test_counts_are_dealt_whole(spark):
    draw = random.Random(3)
    counts = [(c, draw.choice([1, 2, 7, 1000, 10**12])) for c in range(200)]
    overlay = [(draw.randint(0, 150), draw.choice("abcdef"), draw.choice([0, 1, 1, 3, 10**9])) for _ in range(600)]
    got = dealt(spark.createDataFrame(counts, "cell_id long, n long"), spark.createDataFrame(overlay, "cell_id long, label string, weight long"))
    rows = sorted(map(tuple, got.collect()), key=repr)
    assert rows == brute(counts, overlay) and sum(r[2] for r in rows) == sum(n for _, n in counts)


def test_rollup_of_crowded_and_unlabelled_cells(spark):
    cells = spark.createDataFrame([(1, 0.9), (2, 0.1), (3, 0.8), (4, 0.7)], "cell_id long, land double")
    overlay = spark.createDataFrame([(1, "x", 2), (1, "y", 1), (2, "x", 1), (3, "y", 5)], "cell_id long, label string, weight long")
    seen = spark.createDataFrame([(1,)] * 3000 + [(2,)] * 5 + [(3,)] + [(4,)] * 2 + [(None,)], "cell_id long")
    got = lambda *more: {r.label: (r.n, r.n_cells) for r in rollup(seen, overlay, *more).collect()}
    assert got() == {"x": (2005, 2), "y": (1001, 2), None: (3, 1)}
    assert got(cells, F.col("land") > 0.5) == {"x": (2000, 1), "y": (1001, 2), None: (2, 1)}
    assert rollup(seen.limit(0), overlay).collect() == []
