"""Profiles of the names that signals and matters mention."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalloom.functions.text import slug, strip
from signalloom.operators.search import by_locale, placed


def mentions(signals: DataFrame, matters: DataFrame) -> DataFrame:
    """slug, name, type, signal_id and the place in order of every mention; names without a slug are none. signals: line, signal_id, agencies, entities; matters: line, agencies, people, organizations."""

    def of(df: DataFrame, part: int, column: str, kind: str, place: int, signal_id) -> DataFrame:
        rows = df.select(F.lit(part).alias("part"), "line", F.lit(place).alias("place"), F.posexplode(column).alias("pos", "name"), signal_id.alias("signal_id"), F.lit(kind).alias("type"))
        return rows.select("name", "type", "signal_id", F.struct("part", "line", "place", "pos").alias("at"))

    sid, none = F.col("signal_id"), F.lit(None).cast("string")
    parts = [of(signals, 0, "agencies", "agency", 0, sid), of(signals, 0, "entities", "entity", 1, sid)]
    parts += [of(matters, 1, c, kind, i, none) for i, (c, kind) in enumerate([("agencies", "agency"), ("people", "person"), ("organizations", "organization")])]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.withColumn("name", strip(F.coalesce("name", F.lit(""))))
    return out.withColumn("slug", slug(F.col("name"))).where("slug <> ''")


def profiles(mentioned: DataFrame) -> DataFrame:
    """slug, name and type of the first mention (agency, if any mention says so), mention_count, n_signals. A name may be in any number of signals: they are counted, and found by signals_of."""
    return mentioned.groupBy("slug").agg(
        F.min_by("name", "at").alias("name"),
        F.when(F.bool_or(F.col("type") == "agency"), "agency").otherwise(F.min_by("type", "at")).alias("type"),
        F.count(F.lit(1)).alias("mention_count"),
        F.count_distinct("signal_id").alias("n_signals"),
    )


def signals_of(signals: DataFrame, mentioned: DataFrame, name_slug: str) -> DataFrame:
    """The signals that mention a name."""
    return signals.join(mentioned.where(F.col("slug") == name_slug).select("signal_id"), "signal_id", "left_semi")


def by_mentions(profiled: DataFrame) -> DataFrame:
    """profiles with place, from 0: most mentions first, then by name as people sort names."""
    return placed(profiled, F.desc("mention_count"), by_locale(F.col("name")), F.col("name"), F.col("slug"))
