"""First- and last-wins de-duplication, upserts, patches and deletions by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_wins(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """Of the rows of each key the first in the given order, which must be total for a stable result.

    The test on the rank becomes a limit per key before the shuffle, so a hot key sends one row from each partition.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def last_wins(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    return first_wins(df, keys, *(F.col(c).desc() for c in order))


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old with the rows of new in place of those of the same key. Keys are unique in new; nulls equal each other."""
    on = [old[k].eqNullSafe(new[k]) for k in keys]
    return old.join(new, on, "left_anti").unionByName(new, allowMissingColumns=True)


def insert_absent(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old with those rows of new whose key it lacks."""
    on = [new[k].eqNullSafe(old[k]) for k in keys]
    return old.unionByName(new.join(old, on, "left_anti"), allowMissingColumns=True)


def patch(old: DataFrame, changes: DataFrame, key: str, nulls: bool = False) -> DataFrame:
    """old with the columns of changes (one row a key) in the rows of the same key: those that aren't null, or with `nulls` all. Columns that old lacks are added."""
    names = [c for c in changes.columns if c != key]
    new = changes.select(F.col(key), F.lit(True).alias("_hit"), *(F.col(c).alias(f"_{c}") for c in names))
    rows = old.join(new, key, "left")

    def value(c: str) -> Column:
        before = F.col(c) if c in old.columns else F.lit(None)
        return (F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(before) if nulls else F.coalesce(f"_{c}", before)).alias(c)

    kept = [value(c) if c in names else F.col(c) for c in old.columns]
    return rows.select(*kept, *(value(c) for c in names if c not in old.columns))


def delete(old: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """old less the rows whose key is in gone; keys that it lacks change nothing."""
    return old.join(gone.select(key), key, "left_anti")


def stamped(rows: DataFrame, now: Column, key: str = "id", is_new: bool = False) -> DataFrame:
    """rows with updated_date, and, if they are new, an id of their own and created_date where they have none."""
    if is_new:
        has = lambda c, kind: F.col(c) if c in rows.columns else F.lit(None).cast(kind)
        made = F.concat(F.lit("local-"), F.substring(F.sha2(F.to_json(F.struct(F.struct(*rows.columns).alias("row"), F.unix_micros(now).alias("at"))), 256), 1, 32))
        rows = rows.withColumns({key: F.coalesce(F.nullif(has(key, "string"), F.lit("")), made), "created_date": F.coalesce(has("created_date", "timestamp"), now)})
    return rows.withColumn("updated_date", now)
