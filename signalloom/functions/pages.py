"""Titles and paragraphs of HTML pages, as column expressions.

A page is cut into tokens by one pattern: tags, texts, and what is neither shown nor nested (comments, declarations, scripts, styles).
A fold over the tokens keeps the open elements, and notes where paragraphs begin and end and whether an article was
open then; only as many places are kept as paragraphs are asked for. Texts are put together afterwards.
"""

from __future__ import annotations

import html
from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from signalloom.functions.text import bind, strip

VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
#: Elements whose end is the end of a paragraph.
BLOCKS = ("p", "article", "div", "section", "body", "html")
QUOTED = r"""(?:"[^"]*+"|'[^']*+'|[^'">]++)*+"""
#: In turn: what isn't shown, tags, tags that the page ends in, texts.
TOKEN = rf"(?is)<!--.*?(?:-->|\z)|<(script|style)\b.*?(?:</\1\s*+>|\z)|<[!?][^>]*+(?:>|\z)|</?+[a-z]{QUOTED}>|</?+[a-z].*\z|[^<]++|<"
TAG = rf"(?is)^<(/?)([a-z][^\s/>]*+){QUOTED}>$"
TITLE = rf"(?is)<title\b{QUOTED}>(.*?)(?:</title\s*+>|\z)"
UNSHOWN = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b.*?(?:</\1\s*+>|\z)"
#: As the format has it: a reference's name, then perhaps a semicolon.
REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


@cache
def _named() -> tuple[list[str], list[str], str]:
    """Names of characters with their semicolons, what they stand for, and a pattern of those that also stand without one, longest first."""
    names = sorted(n for n in html5 if n.endswith(";"))
    bare = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
    return names, [html5[n] for n in names], "|".join(bare)


def _attribute(tag: Column, name: str) -> Column:
    """An attribute's value in a tag; null if it has none of the name."""
    pattern = rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    value = F.concat(*(F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)))
    return F.when(F.rlike(tag, F.lit(pattern)), unescaped(value))


def _character(code: Column) -> Column:
    """The character of a number, as browsers read numbers: those of 0x80 to 0x9F are Windows characters, impossible ones a replacement character."""
    windows = F.array(*(F.lit(html.unescape(f"&#{n};")) for n in range(0x80, 0xA0)))
    silent = code.between(1, 8) | (code == 0xB) | code.between(0xE, 0x1F) | code.between(0x7F, 0x9F) | code.between(0xFDD0, 0xFDEF) | (code % 65536 >= 0xFFFE)
    return (
        F.when((code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), "�")
        .when(code.between(0x80, 0x9F), F.get(windows, (code - 0x80).cast("int")))
        .when(code == 0xD, "\r")
        .when(silent, "")
        .otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    )


def unescaped(text: Column) -> Column:
    """Text whose character references (named, with or without semicolon, and numbers) are what they stand for."""
    names, values, bare = _named()
    known, meant = (F.split(F.lit("\0".join(x)), "\\x00", -1) for x in (names, values))

    def read(token: Column) -> Column:
        inside = F.substring(token, F.lit(2), F.length(token))
        digits = F.regexp_extract(token, r"^&#[xX]?0*([0-9a-fA-F]*)", 1)
        hexed = F.rlike(token, F.lit("^&#[xX]"))
        # longer numbers are beyond all characters
        code = F.when(F.length(digits) > 7, F.lit(0x110000)).when(digits == "", F.lit(0)).otherwise(F.when(hexed, F.conv(digits, 16, 10)).otherwise(F.conv(digits, 10, 10)).cast("int"))

        def name(place: Column) -> Column:
            short = F.regexp_extract(inside, f"^(?:{bare})", 0)
            longer = F.concat(F.get(meant, F.array_position(known, F.concat(short, F.lit(";"))).cast("int") - 1), F.substring(inside, F.length(short) + 1, F.length(inside)))
            return F.when(place > 0, F.get(meant, place - 1)).when(short != "", longer).otherwise(token)

        return F.when(~F.startswith(token, F.lit("&")) | (F.length(token) == 1), token).when(F.startswith(token, F.lit("&#")), F.when(F.rlike(token, F.lit("^&#[xX]?[0-9a-fA-F]")), bind(code, _character)).otherwise(token)).otherwise(
            bind(F.array_position(known, inside).cast("int"), name)
        )

    tokens = F.regexp_extract_all(text, F.lit(f"{REFERENCE}|[^&]++|&"), F.lit(0))
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(tokens, read), "")).otherwise(text)


def _tokens(page: Column) -> Column:
    """kind (0: text, 1: start, 2: end, 3: neither), name, text and place of each token."""

    def read(token: Column, at: Column) -> Column:
        def named(name: Column) -> Column:
            kind = F.when(name == "", 3).when(F.startswith(token, F.lit("</")), 2).when(name.isin(*VOID) | F.endswith(token, F.lit("/>")), 3).otherwise(1)
            return F.struct(kind.alias("kind"), name.alias("name"), token.alias("text"), at.alias("at"))

        text = F.struct(F.lit(0).alias("kind"), F.lit("").alias("name"), token.alias("text"), at.alias("at"))
        return F.when(~F.startswith(token, F.lit("<")) | (token == "<"), text).otherwise(bind(F.lower(F.regexp_extract(token, TAG, 2)), named))

    return F.transform(F.regexp_extract_all(page, F.lit(TOKEN), F.lit(0)), read)


def _opens_article(tag: Column) -> Column:
    return (tag["kind"] == 1) & ((tag["name"] == "article") | (F.contains(F.lower(tag["text"]), F.lit("article")) & F.contains(F.lower(F.coalesce(_attribute(tag["text"], "class"), F.lit(""))), F.lit("article"))))


def _places(tokens: Column, most: int) -> Column:
    """Where paragraphs are (first token, tokens): the first ones inside articles, and of all. A paragraph ends with its block, or where another one begins."""
    none = F.array().cast("array<struct<first:int,n:int>>")
    start = F.struct(F.lit(None).cast("int").alias("since"), F.array().cast("array<struct<name:string,article:boolean>>").alias("open"), none.alias("inside"), none.alias("all"))

    def step(a: Column, t: Column) -> Column:
        starts, ends = (t["kind"] == 1) & (t["name"] == "p"), (t["kind"] == 2) & t["name"].isin(*BLOCKS)
        stops = (starts | ends) & a["since"].isNotNull()
        place = F.array(F.struct(a["since"].alias("first"), (t["at"] - a["since"]).alias("n")))
        added = lambda has, when: F.when(stops & when & (F.size(has) < most), F.concat(has, place)).otherwise(has)
        last = F.array_position(F.reverse(F.transform(a["open"], lambda e: e["name"])), t["name"])
        opened = F.concat(a["open"], F.array(F.struct(t["name"].alias("name"), t["article"].alias("article"))))
        closed = lambda n: F.when(n > 0, F.slice(a["open"], F.lit(1), (F.size(a["open"]) - n).cast("int"))).otherwise(a["open"])
        # of paragraphs only the start counts, so they needn't be kept open
        now = F.when(starts, a["open"]).when(t["kind"] == 1, opened).otherwise(bind(last, closed))
        since = F.when(starts, t["at"] + 1).when(ends, F.lit(None).cast("int")).otherwise(a["since"])
        return F.struct(since.alias("since"), now.alias("open"), added(a["inside"], F.exists(a["open"], lambda e: e["article"])).alias("inside"), added(a["all"], F.lit(True)).alias("all"))

    tags = F.transform(F.filter(tokens, lambda t: t["kind"].isin(1, 2)), lambda t: F.struct(t["kind"].alias("kind"), t["name"].alias("name"), _opens_article(t).alias("article"), t["at"].alias("at")))
    end = F.array(F.struct(F.lit(2).alias("kind"), F.lit("html").alias("name"), F.lit(False).alias("article"), F.size(tokens).alias("at")))
    return F.aggregate(F.concat(tags, end), start, step, lambda a: F.struct(a["inside"].alias("inside"), a["all"].alias("all")))


def page_texts(page: Column, most: int = 30) -> Column:
    """title and body of a page: og:title or else the title; the first paragraphs of its articles, or if it has none of the page, joined by spaces.

    Texts of a paragraph are stripped and joined by spaces, as they stand between its tags. An article is an element of that name, or with a class whose name has
    the word in it. Null stays null; a page without paragraphs has an empty body.
    """

    def read(tokens: Column) -> Column:
        card = F.get(F.filter(tokens, lambda t: (t["name"] == "meta") & (_attribute(t["text"], "property") == "og:title")), 0)
        shown = unescaped(F.regexp_extract(F.regexp_replace(page, UNSHOWN, ""), TITLE, 1))
        title = F.when(card.isNull(), shown).otherwise(F.coalesce(_attribute(card["text"], "content"), F.lit("")))
        has_article = F.exists(tokens, _opens_article)

        def paragraph(place: Column) -> Column:
            # neighbouring texts are one: "<" alone is a token of its own
            joined = F.array_join(F.transform(F.slice(tokens, place["first"] + 1, place["n"]), lambda t: F.when(t["kind"] == 0, t["text"]).otherwise("\0")), "")
            return F.array_join(F.filter(F.transform(F.split(joined, "\\x00+", -1), lambda x: strip(unescaped(x))), lambda x: x != ""), " ")

        def body(places: Column) -> Column:
            return F.array_join(F.transform(F.when(has_article, places["inside"]).otherwise(places["all"]), paragraph), " ")

        return F.struct(strip(title).alias("title"), bind(_places(tokens, most), body).alias("body"))

    return F.when(page.isNotNull(), bind(_tokens(F.replace(page, F.lit("\0"), F.lit("�"))), read))
