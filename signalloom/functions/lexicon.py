"""Word lists as one regular expression each."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from signalloom.functions import vocabulary as v
from signalloom.functions.text import bind, fold


def folded_term(term: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", term) if not unicodedata.combining(c)).lower()


def pattern(terms: list[str], plural: bool = True) -> str:
    """Any of the terms as whole words, with a plural s if wanted. Whether a character is any term's first is looked at before whether a word starts there, which takes longer; terms are tried by that character."""
    by_first: dict[str, list[str]] = {}
    for term in map(folded_term, terms):
        by_first.setdefault(term[:1], []).append(re.escape(term[1:]))
    first = "" if "" in by_first or not by_first else "(?=[" + "".join(map(re.escape, by_first)) + "])"
    return first + r"\b(?:" + "|".join(f"{re.escape(c)}(?:{'|'.join(rest)})" for c, rest in by_first.items()) + ")" + ("s?" if plural else "") + r"\b"


def mentions(folded: Column, terms: list[str], plural: bool = True) -> Column:
    return folded.rlike(pattern(terms, plural))


def tags_of_folded(folded: Column, lexicon: dict[str, list[str]], plural: bool = True) -> Column:
    hit = F.array(*(F.when(mentions(folded, terms, plural), F.lit(label)) for label, terms in lexicon.items()))
    return F.filter(hit, lambda x: x.isNotNull())


def tags(text: Column, lexicon: dict[str, list[str]], plural: bool = True) -> Column:
    """Labels of which the text has any term, in the lexicon's order; of a null text none."""
    return bind(fold(F.coalesce(text, F.lit(""))), lambda t: tags_of_folded(t, lexicon, plural))


def is_critical(text: Column, terms: list[str] = v.URGENT) -> Column:
    return mentions(fold(F.coalesce(text, F.lit(""))), terms)


def agencies(text: Column, names: dict[str, list[str]] = v.AGENCIES) -> Column:
    return tags(text, names, plural=False)
