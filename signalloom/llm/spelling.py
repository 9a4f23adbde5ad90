"""Spelling variants: words one edit apart, grouped without pairs, in DataFrame functions.

Words are ranked once by how often they occur, then by code point, and stand for their rank from there on: of two
neighbours the better one is the smaller number. Each word leaves one row for each of its positions, keyed by what is
left without it, so one shuffle serves both kinds of neighbours:

* replacements: rows of the same position and key are a wildcard group (position, prefix, suffix). What a member needs of
  it is the group's size and its two best ranks, the second for the best itself. Two words share one group at most.
* insertions and deletions: the key is looked up in the vocabulary, once for each distinct deletion of a word.

Both give (word, neighbours, best neighbour) rows that are summed by word. A group holds at most one word for each
letter, so none is hot; a word of n letters gives n rows of its key, and at most n of its deletions are words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalloom.llm.common import ascii_lower, discard, keep

LETTERS = "[A-Za-zÀ-ÿ]"
#: One in so many occurrences loses a letter.
ONE_IN = 31
#: Keys beyond this many letters are held as two hashes, lest a very long word's keys take the square of its length.
KEY = 64


def occurrences(docs: DataFrame, least: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word: one row for each run of letters with `least` letters or more, A-Z small, after one letter of about one in 31 is deleted as a hash of document and run says."""
    runs = F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(f"{LETTERS}{{{least},}}"), F.lit(0))
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("of"), F.explode(runs).alias("run")).select("of", ascii_lower(F.col("run")).alias("run"))
    rows = rows.withColumn("h", F.crc32(F.concat("of", F.lit(":"), "run").cast("binary")))
    at = F.pmod("h", F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return rows.select(F.when(F.col("h") % ONE_IN == 0, shorter).otherwise(F.col("run")).alias("word")).where(F.length("word") >= least)


def vocabulary(words: DataFrame, at_least: int) -> DataFrame:
    """rank, word, n of words that occur so often; the smaller rank has the larger n, then the smaller word."""
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= at_least)
    return keep(counted.orderBy(F.desc("n"), "word").select(F.monotonically_increasing_id().alias("rank"), "word", "n"), "spelling-words")


def key(part: Column) -> Column:
    hashed = F.concat(F.lit("#"), *(F.lpad(F.hex(F.xxhash64(F.lit(i), part)), 16, "0") for i in (1, 2)))
    return F.when(F.length(part) <= KEY, part).otherwise(hashed)


def neighbours(words: DataFrame) -> DataFrame:
    """rank, n_near, best (rank) of each word (rank, word) that has a word one edit apart."""
    rows = words.select("rank", "word", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("at"))
    without = F.concat(F.substring("word", F.lit(1), F.col("at") - 1), F.substring("word", F.col("at") + 1, F.length("word")))
    # of a letter that stands several times in a row each deletion gives the same word: the last one counts
    last = F.substring("word", F.col("at"), F.lit(1)) != F.substring("word", F.col("at") + 1, F.lit(1))
    rows = rows.select("rank", "at", key(without).alias("key"), last.alias("counts"))
    rows = rows.join(words.select(key(F.col("word")).alias("key"), F.col("rank").alias("shorter")), "key", "left")

    group = Window.partitionBy("key", "at").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.select("rank", "shorter", "counts", F.count(F.lit(1)).over(group).alias("size"), F.first("rank").over(group).alias("first"), F.nth_value("rank", 2).over(group).alias("second"))
    found = lambda of, n, best: F.struct(of.alias("rank"), n.cast("long").alias("n_near"), best.alias("best"))
    one = (F.col("shorter").isNotNull() & F.col("counts")).cast("int")
    other = F.when(F.col("first") == F.col("rank"), F.col("second")).otherwise(F.col("first"))
    each = F.array(found(F.col("rank"), F.col("size") - 1, other), found(F.col("rank"), one, F.col("shorter")), found(F.col("shorter"), one, F.col("rank")))
    rows = rows.where((F.col("size") > 1) | (one == 1)).select(F.inline(F.filter(each, lambda x: x["n_near"] > 0)))
    return rows.groupBy("rank").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """rank, root: where one gets from each word of forms (rank, form) by following forms. Each form occurs at least `ratio` times as often as its word, so paths are short; each round doubles how far they reach."""
    reach = keep(forms.select("rank", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = reach.select(F.col("rank").alias("root"), F.col("root").alias("next"))
        longer = keep(reach.join(onward, "root", "left").select("rank", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        moved = longer.where("moved").limit(1).count()
        discard(reach)
        reach = longer.drop("moved")
        reach._kept_at = longer._kept_at
        if not moved:
            return reach


def variants(docs: DataFrame, least: int = 7, at_least: int = 2, ratio: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Words of docs with the forms that they are probably misspellings of.

    word, form, root, n, n_near, form_n: a row for each distinct run of letters (see `occurrences`) with `least` letters and `at_least`
    occurrences in all texts. n_near is the number of such words exactly one inserted, deleted or replaced letter apart; form is
    the one of them that occurs most often (ties: the smallest by code point), if that is `ratio` times as often as the word,
    else null, as form_n then is; root is where forms lead to, the word itself if it has none.

    A null text has no words, an empty one neither; a null id counts as the empty text in the hash. Repeated rows count
    as often as they occur. A table without words gives an empty result; other columns are ignored. Keys of words
    beyond 65 letters are 128-bit hashes, all others exact.
    """
    words = vocabulary(occurrences(docs, least, id_col, text_col), at_least)
    near = keep(neighbours(words), "spelling-near")
    better = words.select(F.col("rank").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    linked = near.join(words.select("rank", "n"), "rank").join(better, "best").where(F.col("form_n") >= ratio * F.col("n"))
    forms = keep(linked.select("rank", "best", "form", "form_n"), "spelling-forms")
    ends = roots(forms.select("rank", F.col("best").alias("form"))).join(words.select(F.col("rank").alias("root"), F.col("word").alias("end")), "root").select("rank", "end")
    rows = words.join(near.select("rank", "n_near"), "rank", "left").join(forms.drop("best"), "rank", "left").join(ends, "rank", "left")
    return rows.select("word", "form", F.coalesce("end", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
