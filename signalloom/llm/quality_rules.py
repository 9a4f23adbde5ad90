"""Quality rules with adaptive thresholds, in DataFrame functions alone.

Each document is measured once: words, their letters, symbols, repeated lines, words in repeated windows. A few rates of it (in
thousandths) go into quantile sketches, one for each language and source. A sketch counts values by buckets that keep a number's seven
leading bits, so a quantile is off by less than one part in 64; sketches merge by adding up counts, rows in any order give
the same one, and its size depends on the resolution and not on how many rows it has seen. A source with few documents is judged by
the merged sketches of its language, a language with few by those of all.

Thresholds are the quartiles' far-out fences: three times the distance of the quartiles (at least a given resolution)
beyond them. A rate of n words strays by itself, as a count of n times the rate does; so a document fails only if it is
also more than four standard deviations of such a count beyond the fence. Thresholds join documents by language and source.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalloom.functions.text import bind
from signalloom.llm.common import WORD, keep

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
#: Leading bits of a value that a bucket keeps.
BITS = 7
#: Documents that a sketch needs to set thresholds of its own.
ENOUGH = 64
#: Distances of the quartiles that a fence is beyond them, and standard deviations of a count beyond the fence.
FENCE, STRAYS = 3, 4


class Rate(NamedTuple):
    """A count per so many, in thousandths. least: the smallest distance of quartiles that is reckoned with; both: too low fails too."""

    name: str
    count: str
    per: str
    least: int
    both: bool = False


RATES = (
    Rate("letters", "word_chars", "n_words", 250, True),
    Rate("symbols", "n_symbols", "n_words", 20),
    Rate("lines", "n_dup_lines", "n_lines", 100),
    Rate("repeats", "n_repeat_words", "n_words", 50),
)


def repeat_words(words: Column) -> Column:
    """How many words of an array stand in windows of WINDOW words that it has twice or more. Windows are told apart by hashes of 64 bits: in 10^11 texts of a thousand words less than one window is taken for another."""
    hashed = F.when(F.size(words) >= WINDOW, F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))))).otherwise(F.array().cast("array<bigint>"))

    def covered(hashes: Column) -> Column:
        """Places of windows like the one before or behind them in order of hashes, and the words that these windows cover."""
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))

        def twice(rows: Column) -> Column:
            same = lambda x, j: F.coalesce(x["h"] == F.get(rows, j)["h"], F.lit(False))
            alike = F.array_sort(F.transform(F.filter(rows, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["at"]))
            # in order of places, each window covers what the next one doesn't reach
            start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
            added = lambda a, at: F.struct((a["n"] + F.least(F.lit(WINDOW), at - a["last"])).alias("n"), at.alias("last"))
            return F.aggregate(alike, start, added)["n"]

        return bind(placed, twice)

    return bind(hashed, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h)))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words of each row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    whole = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), text.alias("text"))
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.rlike(x, F.lit(WORD)))

    def of_words(words: Column) -> Column:
        letters = F.aggregate(words, F.lit(0).cast("long"), lambda n, w: n + F.length(w))
        return F.struct(F.size(words).cast("long").alias("n_words"), letters.alias("word_chars"), repeat_words(words).alias("n_repeat_words"))

    def of_lines(rows: Column) -> Column:
        return F.struct(F.size(rows).cast("long").alias("n_lines"), (F.size(rows) - F.size(F.array_distinct(rows))).cast("long").alias("n_dup_lines"))

    rows = whole.select("doc_id", "lang", "source", bind(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), of_words).alias("w"), bind(lines, of_lines).alias("l"), F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"))
    return rows.select("doc_id", "lang", "source", "w.n_words", "w.word_chars", "n_symbols", "l.n_lines", "l.n_dup_lines", "w.n_repeat_words")


def bucket(value: Column) -> Column:
    """The smallest value of the bucket that a value (bigint, 0 or more) falls into: its BITS leading bits, the others 0."""
    low = F.greatest(F.lit(0), F.length(F.bin(value)) - BITS)
    return F.call_function("shiftleft", F.call_function("shiftright", value, low), low)


def sketches(rows: DataFrame, by: list[str]) -> DataFrame:
    """by, rate, bucket, n: the quantile sketch of each rate for each value of `by`. Rates of nothing (no lines) are left out."""
    rate = lambda r: F.struct(F.lit(r.name).alias("rate"), F.when(F.col(r.per) > 0, bucket(F.call_function("div", F.lit(1000) * F.col(r.count), F.col(r.per)))).alias("bucket"))
    return rows.select(*by, F.inline(F.array(*map(rate, RATES)))).where(F.col("bucket").isNotNull()).groupBy(*by, "rate", "bucket").agg(F.count(F.lit(1)).alias("n"))


def merged(parts: DataFrame, by: list[str]) -> DataFrame:
    """One sketch of all sketches that are alike in `by`."""
    return parts.groupBy(*by, "rate", "bucket").agg(F.sum("n").alias("n"))


def fences(parts: DataFrame, by: list[str]) -> DataFrame:
    """by, n_docs, and for each rate its low_ and high_ threshold in thousandths, from sketches."""
    order = Window.partitionBy(*by, "rate").orderBy("bucket")
    upto = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))
    rows = parts.withColumn("upto", upto).withColumn("of", F.sum("n").over(Window.partitionBy(*by, "rate")))
    quartile = lambda k: F.min(F.when(4 * F.col("upto") >= k * F.col("of"), F.col("bucket")))
    each = rows.groupBy(*by, "rate").agg(quartile(1).alias("q1"), quartile(3).alias("q3"), F.max("of").alias("of"))
    least = F.element_at(F.create_map(*(x for r in RATES for x in (F.lit(r.name), F.lit(r.least)))), F.col("rate"))
    each = each.withColumn("wide", FENCE * F.greatest(F.col("q3") - F.col("q1"), least))
    pick = lambda r, c: F.max(F.when(F.col("rate") == r.name, c))
    low, high = F.greatest(F.lit(0), F.col("q1") - F.col("wide")), F.col("q3") + F.col("wide")
    return each.groupBy(*by).agg(F.max("of").alias("n_docs"), *(pick(r, low).alias(f"low_{r.name}") for r in RATES), *(pick(r, high).alias(f"high_{r.name}") for r in RATES))


def thresholds(rows: DataFrame) -> DataFrame:
    """lang, source, level (0: its own sketch, 1: its language's, 2: that of all), n_docs of it, and the thresholds of each language and source of rows (as `measured` gives them)."""
    parts = keep(sketches(rows, ["lang", "source"]), "quality-sketches")
    of_lang = keep(merged(parts, ["lang"]), "quality-sketches")
    own, lang, whole = fences(parts, ["lang", "source"]), fences(of_lang, ["lang"]), fences(merged(of_lang, []), [])
    held = [c for c in own.columns if c not in ("lang", "source")]
    as_level = lambda df, i, keys: df.select(*(F.col(k).alias(f"{k}{i}") for k in keys), F.struct(F.lit(i).alias("level"), *held).alias(f"at{i}"))
    table = own.select("lang", "source", F.struct(F.lit(0).alias("level"), *held).alias("at0"))
    table = table.join(as_level(lang, 1, ["lang"]), F.col("lang").eqNullSafe(F.col("lang1"))).drop("lang1")
    table = table.join(F.broadcast(as_level(whole, 2, [])))  # one row
    chosen = F.when(F.col("at0.n_docs") >= ENOUGH, F.col("at0")).when(F.col("at1.n_docs") >= ENOUGH, F.col("at1")).otherwise(F.col("at2"))
    return table.select("lang", "source", chosen.alias("at")).select("lang", "source", "at.*")


def within(r: Rate) -> Column:
    """Whether a document's rate is within its thresholds, as far as its size can tell."""
    n, got = F.col(r.per), 1000 * F.col(r.count)

    def beyond(limit: Column, sign: int) -> Column:
        over = (sign * (got - n * limit)).cast("double")
        return (over > 0) & (over * over > (STRAYS * STRAYS * 1000 * n * F.greatest(limit, F.lit(1))).cast("double"))

    fails = beyond(F.col(f"high_{r.name}"), 1)
    if r.both:
        fails = fails | beyond(F.col(f"low_{r.name}"), -1)
    return ~F.coalesce(fails, F.lit(False))


def judge(docs: DataFrame, fewest: int = 10, most_repeats: int = 20, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, level, failed of each row of docs.

    base_failed: fewer than `fewest` words, or more than `most_repeats` of 100 words in repeated windows. Sketches are of rows that don't
    fail so. kept: neither that nor any rate beyond the thresholds of the row's language and source; failed names the rates that are, level is where the
    thresholds come from (null if the base failed). Null texts are empty, and fail. Null languages and sources are values like any other;
    repeated rows are judged, and counted, one by one; ties in a sketch fall into one bucket. An empty table gives an empty result; other columns are ignored.
    """
    rows = measured(docs, id_col, text_col, lang_col, source_col)
    failed = (F.col("n_words") < fewest) | (100 * F.col("n_repeat_words") > most_repeats * F.col("n_words"))
    rows = keep(rows.withColumn("base_failed", failed), "quality-rows")
    limits = keep(thresholds(rows.where("not base_failed")), "quality-thresholds")
    limits = limits.withColumnsRenamed({"lang": "of_lang", "source": "of_source"})
    same = F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source")) & ~F.col("base_failed")
    rows = rows.join(limits, same, "left")
    beyond = F.array_compact(F.array(*(F.when(~within(r), F.lit(r.name)) for r in RATES)))
    rows = rows.withColumn("failed", F.when(~F.col("base_failed"), beyond)).withColumn("kept", F.coalesce(F.size("failed") == 0, F.lit(False)))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "level", "failed")
