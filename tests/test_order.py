import random

from pyspark.sql import functions as F

from signalloom.operators import entities, search


def test_places_over_many_ranges(spark):
    draw = random.Random(2)
    rows = [(draw.randint(0, 50), i) for i in range(3000)]
    draw.shuffle(rows)
    for key, value in (("spark.sql.adaptive.coalescePartitions.enabled", "false"), ("spark.sql.shuffle.partitions", "7")):
        spark.conf.set(key, value)
    try:
        placed = search.placed(spark.createDataFrame(rows, "a int, b int").repartition(9), F.desc("a"), F.col("b"))
        got = sorted((r.place, r.a, r.b) for r in placed.collect())
        assert placed.select(F.shiftright("place", 33)).distinct().count() == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == [(i, -a, b) for i, (a, b) in enumerate(sorted((-a, b) for a, b in rows))]
    assert search.placed(spark.createDataFrame([], "a int"), F.col("a")).collect() == []


def test_names_in_the_order_of_people(spark):
    names = ["Zorra", "zorra", "ñandú", "Nube", "nube", "Ábaco", "abaco", "Abaco", "ábaco", "oso", "Éxito", "exito", "_x", "10", "9"]
    rows = spark.createDataFrame([(n, f"s{i}", 1 if n != "oso" else 5) for i, n in enumerate(names)], "name string, slug string, mention_count long")
    got = [r.name for r in sorted(entities.by_mentions(rows).collect(), key=lambda r: r.place)]
    assert got == ["oso", "_x", "10", "9", "abaco", "Abaco", "ábaco", "Ábaco", "exito", "Éxito", "ñandú", "nube", "Nube", "zorra", "Zorra"]
