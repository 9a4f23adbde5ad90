"""Document fingerprints by a homomorphic multiset hash, in DataFrame functions alone.

A text is cut into paragraphs: pieces that end behind a line break or a sentence's end mark, so that their
concatenation is the text again. Each piece is hashed to a wide vector; a text's fingerprint is the sum of its pieces'
vectors. So equal texts, and texts of the same pieces in another order, have equal fingerprints; adding or taking out
a piece adds or subtracts its vector and needs nothing else of the text.

A vector has two parts: six check lanes modulo 2^32, which are the printed fingerprint, and 186 one-bit lanes, whose
sums of +1 and -1 (the sketch) estimate inner products, and with them how alike two texts are. One-bit lanes are packed two to a long while they are summed: a
text has less than 2^31 bytes, so neither has more pieces, nor can its check lanes' sums pass 2^63.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalloom.llm.common import keep

#: Hashes of a piece; each fills two check lanes and 62 one-bit lanes.
HASHES = 3
LANE_BITS = 31
LANES = (1, 1 << LANE_BITS)
MOD = 1 << 32
#: Documents whose ids fall into the same range of so many integers are next to each other on one machine.
RANGE = 64
#: Ranges of ids that are looked through together for the next one in use.
SPAN = 4096
#: Spans, and ranges of them, that one window looks through, and how many such levels there are.
FAN, LEVELS = 1 << 16, 2
#: Documents beyond which a range is split (many of one id, or without one), and split ranges that are few enough to go to every task.
HOT, FEW = 1024, 100_000
#: Stands for the range of null ids, below all others.
NO_ID = -(1 << 62)
PIECES = r"(?<=[.!?\n])(?![.!?\n])"


def pieces(text: Column) -> Column:
    return F.filter(F.split(text, PIECES, -1), lambda p: p != "")


def _vector(piece: Column) -> list[Column]:
    """The sums over pieces that make a fingerprint; each is a bigint that stays null where there is no piece."""
    sums = [F.count(piece).alias("n_pieces")]
    for i in range(HASHES):
        h = F.col(f"h{i}")
        sums += [F.try_sum(h.bitwiseAND(F.lit(MOD - 1))).alias(f"c{2 * i}"), F.try_sum(F.shiftrightunsigned(h, 32)).alias(f"c{2 * i + 1}")]
        sums += [F.try_sum(F.shiftrightunsigned(h, k).bitwiseAND(F.lit(sum(LANES)))).alias(f"s{i}_{k}") for k in range(LANE_BITS)]
    return sums


def add_vectors(a: Column, b: Column) -> Column:
    """The check lanes of two texts put together; with negated lanes, of one taken out."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x + y, F.lit(MOD)))


def hex_lanes(checks: Column) -> Column:
    return F.concat_ws("", F.transform(checks, lambda c: F.lower(F.lpad(F.hex(c), 8, "0"))))


def _signed(packed: Column, n: Column) -> Column:
    """The one-bit lanes as sums of +1 and -1."""
    low = F.lit((1 << LANE_BITS) - 1)
    unpacked = F.flatten(F.transform(packed, lambda v: F.array(*(F.shiftrightunsigned(v, LANE_BITS * j).bitwiseAND(low) for j in range(len(LANES))))))
    return F.transform(unpacked, lambda v: (F.lit(2) * v - n).cast("int"))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)


def likeness(a: Column, b: Column) -> Column:
    """Twice the estimated number of pieces in common over that of both, from 0 to 1; of two empty texts 1. a, b: structs of n and signed lanes."""
    norms = _dot(a["lanes"], a["lanes"]) + _dot(b["lanes"], b["lanes"])
    alike = F.when(norms > 0, F.lit(2.0) * _dot(a["lanes"], b["lanes"]) / norms).otherwise(F.when(a["n"] == b["n"], 1.0).otherwise(0.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), alike))


def fingerprint_rows(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """One row per row of rows (keys must tell them apart): keys, n (pieces), checks (array of check lanes), sketch (array of one-bit lanes)."""
    cut = rows.select(*keys, F.explode_outer(pieces(F.col(text))).alias("piece"))
    hashed = cut.select("*", *(F.xxhash64(F.col("piece"), F.lit(i)).alias(f"h{i}") for i in range(HASHES)))
    summed = hashed.groupBy(*keys).agg(*_vector(F.col("piece")))
    zero = F.lit(0).cast("long")
    # hashes of a null piece, where a text has none, don't count
    lane = lambda c: F.when(F.col("n_pieces") > 0, F.coalesce(F.col(c), zero)).otherwise(zero)
    checks = F.array(*(F.pmod(lane(f"c{i}"), F.lit(MOD)) for i in range(2 * HASHES)))
    packed = F.array(*(lane(f"s{i}_{k}") for i in range(HASHES) for k in range(LANE_BITS)))
    return summed.select(*keys, F.col("n_pieces").alias("n"), checks.alias("checks"), _signed(packed, F.col("n_pieces")).alias("sketch"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n, checks, sketch, fingerprint of each distinct (id, text). A null text is an empty one: n 0, all lanes 0."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).distinct()
    got = fingerprint_rows(rows.withColumns({"of": F.xxhash64("text"), "also": F.xxhash64(F.lit(7), "text")}), ["doc_id", "of", "also"], "text").drop("of", "also")
    return got.withColumn("fingerprint", hex_lanes(F.col("checks")))


def next_tops(tops: DataFrame, at: str, levels: int) -> DataFrame:
    """at, next_top: the top of the next lower `at` (a long) of tops (at, top) that there is; that of the highest for the lowest.

    They are laid out by ranges of FAN, these by ranges of FAN again, and so on for so many levels, so no window has more rows than FAN, however far apart they are; what is left after the last level is
    as few as there are ranges of FAN ** levels: some 2^14 of all ids that fit in 64 bits.
    """
    if not levels:
        down = Window.orderBy(F.desc(at))
        everything = down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        last = F.row_number().over(down) == F.count(F.lit(1)).over(everything)
        return tops.select(at, F.when(last, F.first("top").over(everything)).otherwise(F.lead("top").over(down)).alias("next_top"))
    up = f"{at}_{levels}"
    rows = tops.withColumn(up, F.floor(F.col(at) / F.lit(FAN)).cast("long"))
    above = next_tops(rows.groupBy(up).agg(F.max_by("top", at).alias("top")), up, levels - 1)
    rows = rows.withColumn("below", F.lead("top").over(Window.partitionBy(up).orderBy(F.desc(at))))
    return rows.join(above, up).select(at, F.coalesce("below", "next_top").alias("next_top"))


def with_next(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) with part, sub, rn (which tell rows apart), next_text (that of the row that follows by descending doc_id, and of rows of one id by a hash of the text; the first row's follows the last) and is_last (of its part and sub).

    Rows are laid out by ranges of ids (part), of which those with many rows are split (sub); the text that a range's last row needs is the first of the next
    range in use, which is found over ranges, not rows.
    """
    in_range = F.floor(F.col("doc_id") / F.lit(RANGE)).cast("long")
    rows = docs.withColumns({"part": F.coalesce(in_range, F.lit(NO_ID)), "h": F.xxhash64("text")})
    sizes = keep(rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")), "fingerprint-ranges")
    hot = sizes.where(F.col("n") > HOT).select("part", F.ceil(F.log2(F.col("n") / F.lit(HOT))).cast("int").alias("bits"))
    n_hot = hot.count()
    # within a range rows are in order of sub: from the last id down, and within one id by the leading bits of the hash
    place = F.coalesce(F.lit(RANGE - 1) - (F.col("doc_id") - F.col("part") * RANGE), F.lit(0)).cast("long")
    leading = F.shiftrightunsigned(F.col("h").bitwiseXOR(F.lit(-(1 << 63))), 32)
    split = F.expr("shiftleft(place, bits) + shiftright(leading, 32 - bits)")
    if n_hot:
        rows = rows.join(F.broadcast(hot) if n_hot <= FEW else hot, "part", "left").withColumns({"place": place, "leading": leading})
        rows = rows.withColumn("sub", F.when(F.col("bits").isNull(), 0).otherwise(split).cast("long")).drop("bits", "place", "leading")
    else:
        rows = rows.withColumn("sub", F.lit(0).cast("long"))
    group = ["part", "sub"]
    down = Window.partitionBy(*group).orderBy(F.desc("doc_id"), "h", "text")
    laid = rows.select(*group, "doc_id", "text", F.row_number().over(down).alias("rn"), F.lead("text").over(down).alias("next_text"))

    used = rows.join(F.broadcast(hot) if n_hot <= FEW else hot, "part", "left_semi").select(*group).distinct() if n_hot else None
    calm = sizes.where(F.col("n") <= HOT).select("part", F.lit(0).cast("long").alias("sub"))
    used = keep((calm if used is None else calm.unionByName(used)).withColumn("span", F.floor(F.col("part") / F.lit(SPAN)).cast("long")), "fingerprint-used")
    key = F.struct("part", "sub")
    spans = used.groupBy("span").agg(F.max(F.struct("part", (-F.col("sub")).alias("above"))).alias("top")).select("span", F.struct("top.part", (-F.col("top.above")).alias("sub")).alias("top"))
    tops = next_tops(spans, "span", LEVELS)
    in_span = Window.partitionBy("span").orderBy(F.desc("part"), "sub")
    links = used.withColumn("below", F.lead(key).over(in_span)).join(tops, "span")
    links = links.select(*group, F.coalesce("below", "next_top").alias("next")).select(*group, F.col("next.part").alias("next_part"), F.col("next.sub").alias("next_sub"))

    first = laid.where("rn = 1").select(F.col("part").alias("next_part"), F.col("sub").alias("next_sub"), F.col("text").alias("first_text"))
    following = links.join(first, ["next_part", "next_sub"]).select(*group, "first_text")
    joined = laid.join(following, group, "left")
    return joined.select(*group, "rn", "doc_id", "text", F.col("next_text").isNull().alias("is_last"), F.coalesce("next_text", "first_text").alias("next_text"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's fingerprint beside that of an edited text: the last floor(n_chars / 2) code points replaced by as many of the next document's first (or all it has).

    One row per input row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, and what the likeness is
    worked out from: n_pieces, sketch, edited_n_pieces, edited_sketch. Documents follow each other by descending id (null ids last; rows of one id by a hash of the
    text); after the last comes the first, so a lone document follows itself. Null texts are empty ones, whose fingerprint is all zeros; two empty texts
    are alike (1). Texts of any length count whole; likeness is an estimate (standard error about 0.07). An empty table
    gives an empty result; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = F.length("text")
    half = F.floor(n / F.lit(2)).cast("int")
    edited = F.concat(F.expr("substring(text, 1, n_chars - half)"), F.expr("substring(next_text, 1, half)"))
    rows = with_next(rows).withColumn("n_chars", n.cast("int")).withColumn("half", half).withColumn("edited", edited)
    # the next document's vector is that of the next row, but for the last row of a range
    texts = F.when(F.col("is_last"), F.array("text", "edited", "next_text")).otherwise(F.array("text", "edited"))
    keys = ["part", "sub", "rn", "doc_id", "n_chars", "edited_sha256"]
    rows = rows.select("part", "sub", "rn", "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), F.posexplode(texts).alias("which", "of"))
    each = fingerprint_rows(rows, [*keys, "which"], "of")
    both = each.groupBy(*keys).agg(*(F.first(F.when(F.col("which") == i, F.struct("n", "checks", F.col("sketch").alias("lanes"))), ignorenulls=True).alias(f"v{i}") for i in range(3)))
    after = F.lead("v0").over(Window.partitionBy("part", "sub").orderBy("rn"))
    both = both.withColumn("v2", F.coalesce("v2", after))
    return both.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256", hex_lanes(F.col("v0.checks")).alias("fingerprint"), hex_lanes(F.col("v1.checks")).alias("edited_fingerprint"),
        likeness(F.col("v0"), F.col("v1")).alias("near_edited"), likeness(F.col("v0"), F.col("v2")).alias("near_next"),
        F.col("v0.n").alias("n_pieces"), F.col("v0.lanes").alias("sketch"), F.col("v1.n").alias("edited_n_pieces"), F.col("v1.lanes").alias("edited_sketch"),
    )
