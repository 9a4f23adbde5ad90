"""Lookups: dimension joins with defaults, nests, ordered matches, and place names that may collide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalloom.functions.text import fold_words
from signalloom.operators.dedup import first_wins


def with_defaults(df: DataFrame, dimension: DataFrame, on: str, defaults: dict[str, Column]) -> DataFrame:
    """Left join; columns of the dimension that are missing or empty get their default."""
    joined = df.join(dimension, on, "left")
    return joined.withColumns({c: F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), d) for c, d in defaults.items()})


def nested(parents: DataFrame, children: DataFrame, on: str, name: str) -> DataFrame:
    """parents with an array of their children's rows, empty where there are none: for parents of as many children as a row can hold. To count them, aggregate them (views.matter_counts)."""
    rows = children.groupBy(on).agg(F.array_sort(F.collect_list(F.struct(*(c for c in children.columns if c != on)))).alias(name))
    empty = F.array().cast(rows.schema[name].dataType)
    return parents.join(rows, on, "left").withColumn(name, F.coalesce(name, empty))


def first_match(left: DataFrame, right: DataFrame, conditions: list[tuple[list[str], Column | None]], right_id: str, name: str) -> DataFrame:
    """left with the id of the row of right that matches under the first condition that any row meets (keys, and a predicate on right)."""
    out, found = left, []
    for i, (keys, where) in enumerate(conditions):
        rows = right if where is None else right.where(where)
        one = rows.groupBy(*keys).agg(F.min(right_id).alias(f"_m{i}"))
        out = out.join(one, keys, "left")
        found.append(F.col(f"_m{i}"))
    return out.withColumn(name, F.coalesce(*found)).drop(*(f"_m{i}" for i in range(len(conditions))))


def gazetteer_index(features: DataFrame) -> DataFrame:
    """key, candidates (how many features it names), and the feature where it is just one. features: canonical_id, canonical_name, normalized_name, feature_type, group."""
    keys = F.array_distinct(F.array(fold_words(F.col("canonical_name")), fold_words(F.col("normalized_name"))))
    rows = features.select("canonical_id", "canonical_name", "feature_type", "group", F.explode(keys).alias("key")).where("key <> ''")
    rows = first_wins(rows, ["key", "canonical_id"], F.col("canonical_name").desc())
    one = rows.groupBy("key").agg(F.count(F.lit(1)).alias("candidates"), F.min(F.struct("canonical_id", "canonical_name", "feature_type", "group")).alias("f"))
    alone = lambda c: F.when(F.col("candidates") == 1, F.col(f"f.{c}")).alias(c)
    return one.select("key", "candidates", *(alone(c) for c in ("canonical_id", "canonical_name", "feature_type", "group")))


def resolve_places(df: DataFrame, features: DataFrame, place: str) -> DataFrame:
    """df with the feature that its place names: resolution_status resolved, collision_review_required (with candidate_count) or unresolved."""
    index = gazetteer_index(features)
    rows = df.withColumn("key", fold_words(F.col(place))).join(index, "key", "left")
    status = F.when(F.col("candidates").isNull(), "unresolved").when(F.col("candidates") > 1, "collision_review_required").otherwise("resolved")
    return rows.withColumn("resolution_status", status).withColumn("candidate_count", F.when(F.col("candidates") > 1, F.col("candidates"))).drop("key", "candidates")


def missing_references(df: DataFrame, dimension: DataFrame, on: str) -> DataFrame:
    """Keys that the dimension lacks."""
    return df.select(on).distinct().join(dimension.select(on), on, "left_anti")
