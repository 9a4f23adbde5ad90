"""Text folding, slugs and fallbacks as column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import cache
from itertools import chain
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value worked out once however often `then` uses it: the optimizer doesn't copy it into each use."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _folded(char: str) -> str:
    """The rule: compatibility decomposition without combining marks, in lower case. Capital sigma stays, since its small form depends on where it stands."""
    return "".join(c if c == "Σ" else c.lower() for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))


def _ranges(points: list[int]) -> str:
    """Code points, in order, as ranges of a character class."""
    out, at = [], 0
    while at < len(points):
        end = at
        while end + 1 < len(points) and points[end + 1] == points[end] + 1:
            end += 1
        out.append(f"\\x{{{points[at]:X}}}-\\x{{{points[end]:X}}}")
        at = end + 1
    return "".join(out)


#: Hangul syllables decompose by arithmetic into a first, a middle and perhaps a last sound.
HANGUL = range(0xAC00, 0xD7A4)
LEADS, VOWELS, TAILS = "".join(map(chr, range(0x1100, 0x1113))), "".join(map(chr, range(0x1161, 0x1176))), "".join(map(chr, range(0x11A8, 0x11C3)))


#: Where characters are that change; unified ideographs and what is unassigned never do.
CHANGING = (range(0x80, 0x3400), range(0xA000, 0xAC00), range(0xF900, 0x20000), range(0x2F800, 0x2FA20), range(0xE0000, 0xE0200))


class Tables(NamedTuple):
    """marked, plain: characters that become one letter or none, as translate takes them; several: those that become more; latin: a class of all that F.lower and the translation by latin_marked and latin_plain get right; parted: a class of those that become more, and Hangul."""

    marked: str
    plain: str
    several: dict[str, str]
    parted: str
    latin: str
    latin_marked: str
    latin_plain: str


@cache
def tables() -> Tables:
    one, none, several, latin = {}, [], {}, [*range(0x80)]
    is_latin = lambda point: point < 0x250 or 0x300 <= point < 0x370 or 0x1E00 <= point < 0x1F00 or 0x2010 <= point < 0x2027
    for point in chain(*CHANGING):
        char = chr(point)
        plain = _folded(char)
        if len(plain) > 1:
            several[char] = plain
            continue
        if not plain:
            none.append(char)
        elif plain != char:
            one[char] = plain
        if is_latin(point):
            latin.append(point)
    few, gone = {c: p for c, p in one.items() if is_latin(ord(c))}, [c for c in none if is_latin(ord(c))]
    parted = _ranges(sorted(map(ord, several))) + _ranges([*HANGUL])
    return Tables("".join(one) + "".join(none), "".join(one.values()), several, parted, _ranges(latin), "".join(few) + "".join(gone), "".join(few.values()))


@cache
def _fold_of_t() -> str:
    """Folding as a lambda of SQL. It is a long expression that many columns use: as text, it is handed to Spark in one call."""
    t, text = tables(), lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    parted, several, at = text(f"[{t.parted}]"), text("".join(t.several)), f"(ascii(k) - {HANGUL.start})"
    known = f"split({text(chr(0).join(t.several.values()))}, {text(chr(92) + 'x00')}, -1)"
    tail = f"CASE WHEN {at} % 28 > 0 THEN substring({text(TAILS)}, {at} % 28, 1) ELSE '' END"
    syllable = f"concat(substring({text(LEADS)}, cast({at} div 588 AS int) + 1, 1), substring({text(VOWELS)}, cast({at} % 588 div 28 AS int) + 1, 1), {tail})"
    # tokens are runs of characters that stay one, and single others: known ones, or syllables
    token = f"CASE WHEN length(k) > 1 OR NOT rlike(k, {parted}) THEN k WHEN instr({several}, k) > 0 THEN get({known}, instr({several}, k) - 1) ELSE {syllable} END"
    tokens = text(f"(?s)[^{t.parted}]+|[{t.parted}]")
    whole = f"CASE WHEN rlike(t, {parted}) THEN array_join(transform(regexp_extract_all(t, {tokens}, 0), k -> {token}), '') ELSE t END"
    latin = f"translate(lower(t), {text(t.latin_marked)}, {text(t.latin_plain)})"
    # most characters are ASCII: one comparison settles them, where the class alone tries all its ranges
    other = text(f"[\\x{{80}}-\\x{{10FFFF}}&&[^{t.latin}]]")
    return f"t -> CASE WHEN octet_length(t) = length(t) THEN lower(t) WHEN NOT rlike(t, {other}) THEN {latin} ELSE lower(translate({whole}, {text(t.marked)}, {text(t.plain)})) END"


def fold(text: Column) -> Column:
    """Compatibility decomposition without combining marks, in lower case, for every script. Texts of ASCII alone only need the latter, those of Latin letters one translation."""
    return F.element_at(F.call_function("transform", F.array(text), F.expr(_fold_of_t())), 1)


def fold_words(text: Column) -> Column:
    """Folded text in which runs of all but letters and digits are single spaces; null is empty."""
    return F.trim(F.regexp_replace(fold(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", " "))


def slug(text: Column) -> Column:
    """Folded text in which runs of all but letters and digits are single hyphens, none at the ends; null is empty."""
    return F.replace(fold_words(text), F.lit(" "), F.lit("-"))


SPACE = r"[\x09-\x0D\x1C-\x20\x85\p{Z}]"


def strip(text: Column) -> Column:
    """Without white space of any kind, no-break spaces and separators of other scripts included, at the ends."""
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def xml_text(text: Column) -> Column:
    """Text as it stands in an XML document; characters that no document may have are left out."""
    bare = F.regexp_replace(text, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x{FFFE}\x{FFFF}]", "")
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\r", "&#13;")):
        bare = F.replace(bare, F.lit(char), F.lit(name))
    return bare


def filled(*values: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*(F.nullif(v, F.lit("")) for v in values))


def upper_slug(text: Column, prefix: str) -> Column:
    """Upper case, runs of all but letters and digits as single hyphens, behind a prefix."""
    return F.concat(F.lit(prefix), F.regexp_replace(F.regexp_replace(F.upper(text), "[^A-Z0-9]+", "-"), "^-|-$", ""))


def title_of_id(source_id: Column, prefixes: tuple[str, ...]) -> Column:
    """The words of an id less its prefix, in title case; the id itself if that leaves none."""
    bare = source_id
    for p in prefixes:
        bare = F.regexp_replace(bare, f"^{p}", "")
    return filled(F.initcap(F.replace(bare, F.lit("-"), F.lit(" "))), source_id)


def short_target(target: Column, suffix: str) -> Column:
    return F.regexp_replace(target, f"{suffix}$", "")


def truncated(text: Column, most: int, marker: str = "… [truncated]") -> Column:
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit(marker))).otherwise(text)
