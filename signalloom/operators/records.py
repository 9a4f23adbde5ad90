"""Records of a collection by any of their ids: fetched, changed and deleted in batches, with an answer for each request.

A collection has columns of ids (a value may stand in any of them, and need not be unique) and `place`, its rows' order; a value
means the first row that has it. All requests of a batch look at the collection as it was before. Only ids and places are
shuffled to find rows; null requests and null ids match nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def found(asked: DataFrame, key: str, rows: DataFrame, ids: list[str]) -> DataFrame:
    """asked with place: that of the first row that has the key as one of its ids, or null."""
    values = rows.select(F.explode(F.array_distinct(F.array(*ids))).alias(key), "place").where(F.col(key).isNotNull())
    return asked.join(values.groupBy(key).agg(F.min("place").alias("place")), key, "left")


def missing(key: str, entity: str) -> Column:
    return F.when(F.col("place").isNull(), F.concat(F.lit(f"{entity} not found: "), F.coalesce(F.col(key).cast("string"), F.lit("null")))).alias("error")


def fetched(asked: DataFrame, key: str, rows: DataFrame, ids: list[str], entity: str) -> DataFrame:
    """asked with row (a struct of all the row's columns, null if there is none) and error (why there is none, else null)."""
    whole = rows.select("place", F.struct(*(F.col(f"`{c}`") for c in rows.columns if c != "place")).alias("row"))
    return found(asked, key, rows, ids).join(whole, "place", "left").select(*asked.columns, "row", missing(key, entity))


def updated(patches: DataFrame, key: str, rows: DataFrame, ids: list[str], entity: str, now: Column, order: str = "turn") -> tuple[DataFrame, DataFrame]:
    """rows with the patches' columns (those that aren't null) in the rows that their keys mean, and updated_date there; and the answers: key, turn, error.

    Of several patches of one row, whatever ids they name it by, the last by `turn` counts, for each column alone. Columns that rows lack are added.
    """
    names = [c for c in patches.columns if c not in (key, order)]
    at = found(patches, key, rows, ids)
    last = (F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_{c}") for c in names)
    merged = at.where(F.col("place").isNotNull()).groupBy("place").agg(*last, F.lit(True).alias("_hit"))
    before = lambda c: F.col(c) if c in rows.columns else F.lit(None)
    stamp = F.when(F.col("_hit"), now).otherwise(before("updated_date")).alias("updated_date")
    value = {c: F.coalesce(f"_{c}", before(c)).alias(c) for c in names} | {"updated_date": stamp}
    out = rows.join(merged, "place", "left")
    out = out.select(*(value.get(c, F.col(f"`{c}`")) for c in rows.columns), *(v for c, v in value.items() if c not in rows.columns))
    return out, at.select(key, order, missing(key, entity))


def deleted(asked: DataFrame, key: str, rows: DataFrame, ids: list[str]) -> tuple[DataFrame, DataFrame]:
    """rows less those that the keys mean; and the answers: asked with deleted (whether there was such a row) and id (the row's first id column)."""
    at = found(asked, key, rows, ids)
    left = rows.join(at.where(F.col("place").isNotNull()).select("place"), "place", "left_anti").select(rows.columns)
    answers = at.join(rows.select("place", F.col(ids[0]).alias("id")), "place", "left")
    return left, answers.select(*asked.columns, F.col("place").isNotNull().alias("deleted"), "id")


def prioritized(asked: DataFrame, rows: DataFrame, tries: list[tuple[str, str]], newest: str = "created_date") -> DataFrame:
    """asked with place: that of the row that the first of the tries (a column of asked, a column of rows) with any match finds. Of several rows that one try finds the newest counts, then the first. Blank values match nothing."""
    out, places = asked, []
    for i, (mine, theirs) in enumerate(tries):
        best = F.max_by("place", F.struct(F.col(newest), -F.col("place"))).alias(f"_p{i}")
        one = rows.where(F.col(theirs).isNotNull() & (F.col(theirs) != "")).groupBy(F.col(theirs).alias(f"_v{i}")).agg(best)
        out = out.join(one, F.col(mine) == F.col(f"_v{i}"), "left")
        places.append(F.col(f"_p{i}"))
    return out.select(*asked.columns, F.coalesce(*places).alias("place"))
