"""Source divergence audit: how the sources of a language differ in their words.

Pass one counts in how many documents of its language each term stands and keeps those with enough. Pass two builds
automata of the kept terms, each between delimiters, runs them over every whole text and counts what they find per
language and source. Texts stay where they are in both; workers add up terms before anything is shuffled, and hand over
what they hold before it grows large.

An automaton holds up to `TERMS` terms. Languages are dealt to automata by buckets of their hashes; one with more terms
has several automata, and its texts pass each of them. What the driver sees is one automaton's terms at a time.

Counts are sparse postings. All numbers of pairs are sums over all kept terms, most of which neither source has: the
value for a term that is absent is the same for all of them, so a pair starts with that value for every term, terms
that one source has correct it by that source's histogram of shares, and terms that both have correct it by a join of
postings. Shares are integers, and so are all sums: results are exact.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalloom.llm.common import keep, one_model, tidy

#: Terms of one automaton, and buckets that languages are dealt to by a hash.
TERMS, BUCKETS = 1 << 19, 1024
#: Entries that a task counts, and occurrences that it holds, before it hands them over.
HELD, FOUND = 1 << 19, 1 << 22
#: What a share of one is.
WHOLE = 10**9
#: Terms are runs of letters A-Z, a-z and all characters beyond ASCII. What each byte becomes: A-Z their small letters, what no term has a blank.
TERM_BYTES = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def read_as(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """lang, source and text in bytes, nulls as empty texts."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return docs.select(empty(lang_col).alias("lang"), empty(source_col).alias("source"), empty(text_col).cast("binary").alias("text"))


def _handed_over(counts: dict[str, Counter]) -> pa.RecordBatch:
    langs = pa.concat_arrays([pa.array([], pa.string()), *(pa.repeat(pa.scalar(lang, pa.string()), len(c)) for lang, c in counts.items())])
    terms = pa.array([t for c in counts.values() for t in c], pa.binary())
    return pa.RecordBatch.from_arrays([langs, terms, pa.array([n for c in counts.values() for n in c.values()], pa.int64())], ["lang", "term", "n"])


def document_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, term, n: in how many documents of the language a task has seen the term since it last handed over."""
    counts, held = defaultdict(Counter), 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            mine = counts[lang]
            before = len(mine)
            mine.update(set(text.as_py().translate(TERM_BYTES).split()))
            held += len(mine) - before
            if held >= HELD:
                yield _handed_over(counts)
                counts, held = defaultdict(Counter), 0
    yield _handed_over(counts)


def kept_terms(rows: DataFrame, least_docs: int) -> DataFrame:
    """lang, term of the terms that at least so many documents of the language have."""
    counted = rows.select("lang", "text").mapInArrow(tidy(document_terms), "lang string, term binary, n long")
    return keep(counted.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= least_docs).select("lang", "term"), "audit-terms")


def automata(sent: bytes) -> tuple[dict[str, ahocorasick.Automaton], pa.Array]:
    """For each language the automaton of its terms, with delimiters around them, that says each one's place among all terms sent (an Arrow stream); and these. Bytes are taken for characters."""
    table = pa.ipc.open_stream(sent).read_all().combine_chunks()
    made = defaultdict(ahocorasick.Automaton)
    for i, (lang, term) in enumerate(zip(table.column("lang").to_pylist(), table.column("term").to_pylist())):
        made[lang].add_word(f" {term.decode('latin-1')} ", i)
    for found in made.values():
        found.make_automaton()
    return dict(made), pa.concat_arrays([pa.array([], pa.binary()), *table.column("term").chunks])


def _recounted(sent):
    """A function over a task's batches (lang, source, text) that counts the terms sent (Arrow, broadcast) in texts of their languages: lang, source, term, n."""

    def added_up(keys: dict, found: list, terms: pa.Array) -> pa.RecordBatch:
        codes, n = np.unique(np.concatenate([np.empty(0, np.int64), *found]), return_counts=True)
        of, names = pa.array(codes >> 32), list(zip(*keys)) or [(), ()]
        return pa.RecordBatch.from_arrays([pa.array(names[0], pa.string()).take(of), pa.array(names[1], pa.string()).take(of), terms.take(pa.array(codes & 0xFFFFFFFF)), pa.array(n, pa.int64())], ["lang", "source", "term", "n"])

    def run(batches):
        by_lang, terms = one_model(automata, sent.value)
        place = itemgetter(1)
        keys, found, held = {}, [], 0  # keys are numbered as they come; what is found is number of key and place of term
        for batch in batches:
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text")):
                if lang in by_lang:
                    padded = f" {text.as_py().translate(TERM_BYTES).decode('latin-1')} "
                    places = np.fromiter(map(place, by_lang[lang].iter(padded)), np.int64)
                    found.append(places + (keys.setdefault((lang, source), len(keys)) << 32))
                    held += len(places) + 1
                    if held >= FOUND:
                        yield added_up(keys, found, terms)
                        keys, found, held = {}, [], 0
        yield added_up(keys, found, terms)

    return run


def dealt_terms(terms: DataFrame) -> tuple[Column, dict[int, list[int]]]:
    """Which automaton each of terms (lang, term) belongs to, and for each automaton the buckets of languages that it serves."""
    bucket = F.pmod(F.xxhash64("lang"), F.lit(BUCKETS)).cast("int")
    sizes = sorted(map(tuple, terms.groupBy(bucket.alias("bucket")).count().collect()), key=lambda x: (-x[1], x[0]))  # one row a bucket at most
    first, parts, serves, room = {}, {}, {}, 0
    last = -1
    for b, n in sizes:
        k = -(-n // TERMS)
        if k > 1 or n > room:
            first[b], parts[b], room = last + 1, k, TERMS - n if k == 1 else 0
            last += k
        else:
            first[b], parts[b], room = last, 1, room - n
        for i in range(first[b], first[b] + k):
            serves.setdefault(i, []).append(b)
    if not sizes:
        return F.lit(0), {}
    of = lambda table: F.element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), bucket)
    return of(first) + F.pmod(F.xxhash64("term"), of(parts)).cast("int"), serves


def postings(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """lang, source, term, count of each kept term where it occurs, recounted in all texts."""
    spark = rows.sparkSession
    automaton, serves = dealt_terms(terms)
    dealt = terms.withColumn("automaton", automaton)
    counted = None
    for i, buckets in serves.items():
        table = dealt.where(F.col("automaton") == i).select("lang", "term").toArrow()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        sent = spark.sparkContext.broadcast(sink.getvalue().to_pybytes())
        served = rows.where(F.pmod(F.xxhash64("lang"), F.lit(BUCKETS)).cast("int").isin(buckets))
        part = served.mapInArrow(_recounted(sent), "lang string, source string, term binary, n long")
        counted = part if counted is None else counted.unionByName(part)
    if counted is None:
        counted = spark.createDataFrame([], "lang string, source string, term binary, n long")
    return keep(counted.groupBy("lang", "term", "source").agg(F.sum("n").alias("count")), "audit-postings")


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(WHOLE * (count + 1) / (total + terms)), exact: in 64 bits where they hold the product."""
    wide = F.call_function("div", (count + 1).cast("decimal(20,0)") * F.lit(WHOLE).cast("decimal(10,0)"), (total + terms).cast("decimal(20,0)")).cast("long")
    return F.lit(1).cast("long") + F.when(count < F.lit((1 << 63) // WHOLE - 1), F.call_function("div", (count + 1).cast("long") * F.lit(WHOLE).cast("long"), total + terms)).otherwise(wide)


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q)."""
    return F.call_function("div", (p - q) * (p - q), q)


def pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value for each two sources of a language: gaps of the first source's shares from the second's, over all kept terms.

    groups: lang, source, v (kept terms of the language), absent (the share of a term that the source hasn't). shares: lang, source, term, p and absent of terms that it has.
    """
    second = groups.select("lang", F.col("source").alias("item"), F.col("absent").alias("other"))
    both = groups.join(second, "lang").where(F.col("source") != F.col("item"))
    start = both.select("lang", "source", "item", F.when(F.col("v") > 0, F.col("v") * gap(F.col("absent"), F.col("other"))).otherwise(0).alias("value"))

    has = shares.groupBy("lang", "source", "absent", "p").agg(F.count(F.lit(1)).alias("times"))
    has = has.join(second, "lang").where(F.col("source") != F.col("item")).groupBy("lang", "source", "item")
    of = has.agg(F.sum(F.col("times") * (gap(F.col("p"), F.col("other")) - gap(F.col("absent"), F.col("other")))).alias("there"), F.sum(F.col("times") * (gap(F.col("other"), F.col("p")) - gap(F.col("other"), F.col("absent")))).alias("back"))
    each = lambda there, back: F.inline(F.array(F.struct("source", "item", F.col(there).alias("value")), F.struct(F.col("item").alias("source"), F.col("source").alias("item"), F.col(back).alias("value"))))
    one_has = of.select("lang", each("there", "back"))

    q, absent = F.col("q"), F.col("other")
    one, other = shares.select("lang", "term", "source", "p", "absent"), shares.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("q"), F.col("absent").alias("other"))
    moved = lambda x, x0, y, y0: F.sum(gap(x, y) - gap(x, y0) - gap(x0, y))
    p, none = F.col("p"), F.col("absent")
    met = one.join(other, ["lang", "term"]).where(F.col("source") < F.col("item")).groupBy("lang", "source", "item", "absent", "other")
    met = met.agg(F.count(F.lit(1)).alias("times"), moved(p, none, q, absent).alias("there"), moved(q, absent, p, none).alias("back"))
    met = met.withColumn("there", F.col("there") + F.col("times") * gap(none, absent)).withColumn("back", F.col("back") + F.col("times") * gap(absent, none))
    both_have = met.select("lang", each("there", "back"))

    return start.unionByName(one_has).unionByName(both_have).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least_docs: int = 3, top: int = 200, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: for each source of a language how far each other source of it is (part `pair`), and its `top` most overused terms (part `term`).

    Null text, lang and source are read as empty texts. A language keeps the terms that at least `least_docs` of its documents have. A source's
    share of a term is 1 + floor(10^9 * (count + 1) / (N + V)), with N its kept terms' occurrences and V their number;
    the gap of shares p and q is floor((p - q)^2 / q). A pair's value is the sum of gaps over all kept terms, 0 if the
    language keeps none; a term's is the gap from the whole language's share, for terms that the source has and uses more. Ranks go by
    value, largest first, then by the item's bytes; pairs are ranked and kept all. A source alone in its language has
    no pairs. Repeated rows count as often as they occur; an empty table gives an empty result; other columns are ignored.
    """
    rows = read_as(docs, text_col, lang_col, source_col)
    terms = kept_terms(rows, least_docs)
    posted = postings(rows, terms)
    totals = posted.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    kept = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    groups = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(kept, "lang", "left")
    groups = groups.select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v"))
    groups = keep(groups.withColumn("absent", F.when(F.col("v") > 0, share(F.lit(0), F.col("n"), F.col("v")))), "audit-groups")
    shares = posted.join(groups, ["lang", "source"]).withColumn("p", share(F.col("count"), F.col("n"), F.col("v")))

    far = pairs(shares, groups).withColumn("part", F.lit("pair"))
    far = far.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))

    whole = groups.groupBy("lang").agg(F.sum("n").alias("all"))
    used = shares.withColumn("count", F.sum("count").over(Window.partitionBy("lang", "term"))).join(whole, "lang").withColumn("q", share(F.col("count"), F.col("all"), F.col("v")))
    used = used.where(F.col("p") > F.col("q")).select("lang", "source", F.col("term").cast("string").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    used = used.withColumn("part", F.lit("term")).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))).where(F.col("rank") <= top)
    return far.select("lang", "source", "part", "item", "value", "rank").unionByName(used.select("lang", "source", "part", "item", "value", "rank"))
