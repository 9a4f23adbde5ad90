"""Amounts, stages, names and page texts taken out of free text."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from signalloom.functions import vocabulary as v
from signalloom.functions.lexicon import mentions, pattern, tags_of_folded
from signalloom.functions.text import bind, fold, strip

# The forms of amounts, and below the cues of recipients.
_SCALE = "|".join(sorted(map(re.escape, v.SCALES), key=len, reverse=True))
_NUMBER = r"(\d[\d,]*(?:\.\d+)?)"
#: Amounts in dollars: $ before a scaled number, a dollar word behind one, or $ before a plain number of four digits or more.
SCALED_BEFORE = rf"(?:us)?\$\s*{_NUMBER}\s*({_SCALE})\b"
SCALED_BEHIND = rf"{_NUMBER}\s*({_SCALE})\s*(?:de\s+)?(?:dolares|dollars|usd)\b"
PLAIN = r"(?:us)?\$\s*(\d{1,3}(?:,\d{3})+(?:\.\d+)?|\d{4,}(?:\.\d+)?)"
#: What stands in any of these.
DOLLARS = ("$", "dolares", "dollars", "usd")


def _number(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit("")).try_cast("double")


def amounts_of_folded(folded: Column) -> Column:
    """All dollar amounts of a folded text, as array<double>. A text without a dollar sign or word, which every form has, isn't looked through."""
    scale = F.create_map(*(F.lit(x) for pair in v.SCALES.items() for x in pair))
    scaled = [F.zip_with(F.regexp_extract_all(folded, F.lit(p), F.lit(1)), F.regexp_extract_all(folded, F.lit(p), F.lit(2)), lambda n, s: _number(n) * F.element_at(scale, s)) for p in (SCALED_BEFORE, SCALED_BEHIND)]
    found = F.filter(F.concat(*scaled, F.transform(F.regexp_extract_all(folded, F.lit(PLAIN), F.lit(1)), _number)), lambda x: x.isNotNull())
    return F.when(reduce(or_, (F.contains(folded, F.lit(x)) for x in DOLLARS)), found).otherwise(F.array().cast("array<double>"))


def amounts(text: Column) -> Column:
    """All dollar amounts of a text, as array<double>."""
    return bind(fold(F.coalesce(text, F.lit(""))), amounts_of_folded)


def headline_amount(text: Column) -> Column:
    """The largest dollar amount; null if there is none."""
    return F.array_max(amounts(text))


def stage_of_folded(folded: Column, award: list[str] = v.AWARD, solicitation: list[str] = v.SOLICITATION) -> Column:
    return F.when(mentions(folded, award, False), "award_announced").when(mentions(folded, solicitation, False), "rfp_open")


def stage(text: Column, award: list[str] = v.AWARD, solicitation: list[str] = v.SOLICITATION) -> Column:
    return bind(fold(F.coalesce(text, F.lit(""))), lambda t: stage_of_folded(t, award, solicitation))


def beat_of_folded(folded: Column, procurement: list[str] = v.PROCUREMENT) -> Column:
    return F.when(mentions(folded, procurement, False), "procurement")


def beat(text: Column, procurement: list[str] = v.PROCUREMENT) -> Column:
    return beat_of_folded(fold(F.coalesce(text, F.lit(""))), procurement)


# What a name looks like.
_TOKEN = r"[A-Z0-9][A-Za-z0-9.&'\-]*"
_ENTITY = rf"{_TOKEN}(?:\s+(?:de|del|of|and|y|la|el|los|the|{_TOKEN}))*"
#: Cues that name who got an award, each with the name in its first group.
RECIPIENT_CUES = [rf"({_ENTITY})\s+announces\b", rf"\bawarded\s+to\s+({_ENTITY})", rf"(?i)\badjudic\w*\s+a\s+({_ENTITY})", rf"\b({_TOKEN}\s+(?:JV|Joint Venture))\b"]


def recipients(title: Column, body: Column, source: Column, procurement: list[str] = v.PROCUREMENT, agencies: dict[str, list[str]] = v.AGENCIES, folded: Column | None = None) -> Column:
    """Names of those who got an award: the source, if it tells of itself, then what the cues name.

    Names under three characters and those of agencies are left out; of names alike but for case the first stays. folded: title and body folded, where that is at hand.
    """
    text = F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(body, F.lit("")))
    source = F.coalesce(source, F.lit(""))
    own = (source != "") & mentions(fold(text) if folded is None else folded, procurement, False) & F.contains(fold(F.coalesce(title, F.lit(""))), fold(source))
    cued = [F.transform(F.regexp_extract_all(text, F.lit(p), F.lit(1)), strip) for p in RECIPIENT_CUES]
    found = F.concat(F.when(own, F.array(strip(source))).otherwise(F.array().cast("array<string>")), *cued)
    funders = pattern([t for terms in agencies.values() for t in terms], plural=False)
    fine = F.filter(found, lambda n: (F.length(n) >= 3) & ~fold(n).rlike(funders))
    first = lambda kept, n: F.when(F.exists(kept, lambda k: F.lower(k) == F.lower(n)), kept).otherwise(F.concat(kept, F.array(n)))
    return F.aggregate(fine, F.array().cast("array<string>"), first)


def enrichment(title: Column, body: Column, source: Column, folded: Column) -> dict[str, Column]:
    """The columns that an item is enriched with. folded: title and body, with a space between them, folded."""
    return {
        "municipalities": F.array().cast("array<string>"), "recipients": recipients(title, body, source, folded=folded), "agencies": tags_of_folded(folded, v.AGENCIES, plural=False),
        "estimated_value": F.array_max(amounts_of_folded(folded)), "signal_stage": stage_of_folded(folded), "beat": beat_of_folded(folded),
    }
