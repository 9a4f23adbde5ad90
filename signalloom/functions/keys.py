"""Deterministic keys, times and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from signalloom.functions import vocabulary as v
from signalloom.functions.numbers import round_exact
from signalloom.functions.text import filled, slug


def iso(ts: Column) -> Column:
    """ISO-8601 with offset; microseconds only where there are any."""
    micros = F.unix_micros(ts) % 1_000_000
    return F.when(micros == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"))


def item_id(url: Column, published: Column) -> Column:
    return F.substring(F.sha2(F.concat(url, F.lit("|"), iso(published)), 256), 1, 16)


def hash_id(prefix: str, *parts: Column) -> Column:
    """prefix_ and 32 hex digits of the parts' hash; a null part counts as an empty one."""
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha2(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)), 256), 1, 32))


def day(date: Column) -> Column:
    """yyyymmdd of an ISO date, `undated` if there is none."""
    return F.coalesce(F.nullif(F.replace(F.substring(date, 1, 10), F.lit("-"), F.lit("")), F.lit("")), F.lit("undated"))


def matter_id(matter_type: Column, title: Column, first_seen: Column, jurisdiction: Column | None = None) -> Column:
    where = F.lit("PR") if jurisdiction is None else filled(jurisdiction, F.lit("PR"))
    name = filled(F.substring(slug(title), 1, 48), F.lit("untitled"))
    return F.concat_ws("-", F.upper(where), F.upper(filled(matter_type, F.lit("matter"))), day(first_seen), name)


def record_key(matter: Column, record_type: Column, *identifiers: Column) -> Column:
    """Canonical key of an official record; the first identifier that is filled counts."""
    return F.concat_ws("::", matter, slug(filled(record_type, F.lit("official_record"))), slug(filled(*identifiers, F.lit("unknown"))))


def record_type(matter_type: Column, types: dict[str, str] = v.RECORD_TYPES) -> Column:
    known = F.create_map(*(F.lit(x) for pair in types.items() for x in pair))
    return F.coalesce(F.element_at(known, matter_type), F.lit(v.DEFAULT_RECORD_TYPE))


def stage_order(stage: Column, stages: dict[str, int] = v.STAGES) -> Column:
    known = F.create_map(*(F.lit(x) for pair in stages.items() for x in pair))
    return F.coalesce(F.element_at(known, stage), F.lit(v.DEFAULT_STAGE))


def band(score: Column, bands=v.BANDS) -> Column:
    """Name of the band that a score from 0 to 100 is in; no score counts as 0."""
    out = F.lit(bands[-1][1])
    for least, name in reversed(bands[:-1]):
        out = F.when(F.coalesce(score, F.lit(0.0)) >= least, name).otherwise(out)
    return out


def clamp(x: Column) -> Column:
    return F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))


def per_hundred(score: Column, digits: int = 3) -> Column:
    """A score from 0 to 100 as one from 0 to 1, rounded by its exact value, ties to even; none counts as 0."""
    return round_exact(F.coalesce(score.cast("double"), F.lit(0.0)) / 100.0, digits)


def percent(confidence: Column) -> Column:
    """A confidence as a percentage with one place, rounded by its exact value, ties to even."""
    return round_exact(confidence.cast("double") * 100.0, 1)
