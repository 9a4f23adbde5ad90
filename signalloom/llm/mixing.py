"""Mixing sources to target weights, in DataFrame functions alone.

Each source's documents fall into blocks by a hash. The mix takes a number of whole passes over a source, then whole
blocks in permuted order, then, of the block that the target cuts through, sub-blocks and at last single documents.
What it takes is dealt to output shards by a splitting tree: a node holds how many blocks of each source its shards
get together, and its children draw theirs by a multivariate hypergeometric draw, so that every count stays exact. Within a
source, permuted blocks go to shards by these quotas; within a shard, documents are shuffled.

Draws come from hashes, so reruns agree. Sources are rows like documents: nothing that grows with their number is held
in one row or sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalloom.llm.common import WORD, discard, keep
from signalloom.operators.search import placed

#: Documents that a leaf, which is filled one document at a time, holds on average.
LEAF = 64
#: Words that a shard is to hold, and the fewest shards.
SHARD_WORDS, LEAST_SHARDS = 1 << 24, 16
#: Sources that are summed up in order in one task, and blocks of a node that are ranked in one.
RUN, PART = 1 << 12, 1 << 12
#: Nodes (a row each) that are broadcast; of more, the rows of a node are joined with it.
FEW_NODES = 1 << 16


def uniform(*of) -> Column:
    """A number from 0 to 1, decided by what it is of."""
    return F.shiftrightunsigned(F.xxhash64(*of), 11) / F.lit(float(1 << 53))


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Distinct (doc_id, source, size) and how many rows have it (times)."""
    size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long")
    return docs.groupBy(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size")).agg(F.count(F.lit(1)).alias("times"))


def targets(sizes: DataFrame, weights: list[float], most: float) -> DataFrame:
    """Per source: rank (by code point, null last), source_size, n (documents), target.

    A source's share of all sizes is by weight, but at most `most` times its size; what that leaves goes to the others by
    weight. That is one level, at which every source that isn't full stands: the highest of those that result if the
    sources full first are taken to be full. Sources are put in order by ranges, and summed up by runs of RUN of them, so no task sees all.
    """
    per = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("times")).alias("source_size"), F.count(F.lit(1)).alias("n"))
    per = placed(per, F.asc_nulls_last("source")).withColumn("rank", (F.col("place") + 1).cast("int")).drop("place")
    per = per.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1))
    per = per.withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    per = placed(per, F.col("cap") / F.col("weight"), F.col("rank")).withColumn("run", F.floor(F.col("place") / F.lit(RUN)))
    total = per.agg(F.sum("source_size").alias("n")).first().n or 0
    before, behind = (Window.unboundedPreceding, -1), (1, Window.unboundedFollowing)
    runs, within = Window.orderBy("run"), Window.partitionBy("run").orderBy("place")
    summed = lambda c, over: F.coalesce(F.sum(c).over(over), F.lit(0.0))
    sums = per.groupBy("run").agg(F.sum("cap").alias("caps"), F.sum("weight").alias("weights"))
    sums = sums.select("run", summed("caps", runs.rowsBetween(*before)).alias("caps"), summed("weights", runs.rowsBetween(*behind)).alias("weights"))
    full = F.col("caps") + summed("cap", within.rowsBetween(*before))
    rest = F.col("weights") + F.col("weight") + summed("weight", within.rowsBetween(*behind))
    level = per.join(sums, "run").select(((F.lit(total) - full) / rest).alias("level")).agg(F.max("level").alias("level")).first().level
    return per.select("source", "rank", "source_size", "n", F.least(F.col("cap"), F.lit(level or 0.0) * F.col("weight")).alias("target"))


def fill(blocks: DataFrame, by: list[str], block: str, seed: int) -> DataFrame:
    """Which blocks (words each) a need is met with, in permuted order: extra is 1 for those that fit whole, 0 for those behind; null, with what is still missing (lack), for the one that it ends in."""
    order = Window.partitionBy(*by).orderBy(F.xxhash64(*by, block, F.lit(seed)), block)
    upto = F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0))
    lack = F.col("need") - (F.col("upto") - F.col("words"))
    return (
        blocks.withColumn("upto", upto)
        .withColumn("extra", F.when(F.col("upto") <= F.col("need"), 1).when(lack <= 0, 0))
        .withColumn("lack", F.when(F.col("extra").isNull(), lack))
        .drop("upto")
    )


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """Deal each source's blocks (rank, quota) to shards: a written table of rank, quota, where that isn't 0, and first (the shard).

    From the root, each node's shards are halved and the left half's blocks drawn from the node's. All levels hold rows
    (first and number of a node's shards, rank, quota); each is written, so that the next reads it.
    """
    node = keep(quotas.where("quota > 0").select("rank", "quota", F.lit(0).alias("first"), F.lit(shards).alias("k")), "mix-nodes")
    for level in range((shards - 1).bit_length()):
        node, above = keep(halved(node, 1 << level, seed), "mix-nodes"), node
        discard(above)
    return node


def halved(node: DataFrame, nodes: int, seed: int) -> DataFrame:
    """The two children of each node (rank, quota, first, k); nodes of one shard stay. At most `nodes` nodes.

    A multivariate hypergeometric draw: every block of a node has a number by hash, and the left half gets those with the
    least. Numbers fall into parts of some PART blocks; only parts are summed up in order, and blocks within one.
    """
    half = F.floor(F.col("k") / F.lit(2)).cast("int")
    totals = node.where("k > 1").groupBy("first", "k").agg(F.sum("quota").alias("all"))
    draw = F.floor(F.col("all") * half / F.col("k")).cast("long")
    totals = totals.select("first", half.alias("half"), draw.alias("draw"), F.ceil(F.col("all") / F.lit(PART)).alias("parts"))
    blocks = node.where("k > 1").join(F.broadcast(totals) if nodes <= FEW_NODES else totals, "first")
    blocks = blocks.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("quota")))).withColumn("number", uniform("first", "k", "rank", "i", F.lit(seed)))
    blocks = blocks.withColumn("part", F.floor(F.col("number") * F.col("parts")))
    upto = Window.partitionBy("first").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("first", "part").agg(F.count(F.lit(1)).alias("n")).select("first", "part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("first", "part").orderBy("number", "rank", "i"))
    drawn = blocks.join(parts, ["first", "part"]).withColumn("left", F.col("before") + place <= F.col("draw"))
    quotas = drawn.groupBy("first", "k", "half", "rank").agg(F.count_if("left").alias("left"), F.count(F.lit(1)).alias("all"))
    child = lambda first, k, quota: F.struct(first.alias("first"), k.alias("k"), quota.alias("quota"))
    both = F.array(child(F.col("first"), F.col("half"), F.col("left")), child(F.col("first") + F.col("half"), F.col("k") - F.col("half"), F.col("all") - F.col("left")))
    return quotas.select("rank", F.inline(both)).where("quota > 0").select("rank", "quota", "first", "k").unionByName(node.where("k = 1"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3, shards: int | None = None, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """What a mix takes of each document, and the shards that its copies go to.

    One row per input row: doc_id, source, size (words; of a null text 0), source_size, target, copies, taken (size * copies),
    shards and orders (arrays: for each copy the shard that it goes to, and the number by which the shard is shuffled). Sources sorted by code point, null last, weigh by `weights`, repeating. No
    document is taken more than `most` times. A source's taken words stay below its target by less than the smallest
    document of its last leaf that was left out. There are as many shards as the words ask for (SHARD_WORDS each) unless a number is given, but no more than
    blocks are drawn. Rows alike in id, source and size are taken alike. Null ids are ids like any other. An empty
    table gives an empty result; other columns are ignored.
    """
    sizes = keep(sized(docs, id_col, text_col, source_col), "mix-sizes")
    aims = per = keep(targets(sizes, list(weights), most), "mix-targets")
    has = F.col("source_size") > 0
    passes = F.when(has, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(int(most)))).otherwise(0).cast("int")
    per = per.withColumn("passes", passes).withColumn("need", F.when(has & (F.col("passes") < most), F.col("target") - F.col("passes") * F.col("source_size")).otherwise(0.0))
    per = per.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.sqrt(F.col("n") / F.lit(LEAF)))).cast("long"))
    block = lambda n, salt: F.pmod(F.xxhash64("doc_id", F.lit(seed + salt)), n)
    rows = sizes.join(per.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of", "n")
    rows = rows.withColumn("block", block(F.col("blocks"), 1)).drop("blocks").withColumn("words", F.col("size") * F.col("times"))

    blocks = rows.groupBy("rank", "block").agg(F.sum("words").alias("words"), F.count(F.lit(1)).alias("n"), F.first("need").alias("need"), F.first("passes").alias("passes"))
    blocks = keep(fill(blocks, ["rank"], "block", seed + 2), "mix-blocks")
    chosen = blocks.select("rank", "block", "extra", F.col("lack").alias("need"), F.greatest(F.lit(1), F.ceil(F.col("n") / F.lit(LEAF))).cast("long").alias("leaves"))
    rows = rows.drop("need").join(chosen, ["rank", "block"])

    cut = rows.where(F.col("extra").isNull()).drop("extra").withColumn("leaf", block(F.col("leaves"), 3))
    leaves = fill(cut.groupBy("rank", "leaf").agg(F.sum("words").alias("words"), F.first("need").alias("need")), ["rank"], "leaf", seed + 4)
    cut = cut.drop("need", "leaves").join(leaves.select("rank", "leaf", "extra", F.col("lack").alias("need")), ["rank", "leaf"])
    one = F.struct("words", "doc_id", "size", "times", "source", "source_size", "target", "passes", "block")
    last = cut.where(F.col("extra").isNull()).groupBy("rank").agg(F.sort_array(F.collect_list(one), asc=False).alias("has"), F.first("need").alias("need"))
    kind = "array<" + dict(last.dtypes)["has"][len("array<") : -1].replace("struct<", "struct<extra:int,", 1) + ">"

    def take(acc, x):
        fits = x["words"] <= acc["need"]
        row = F.struct(fits.cast("int").alias("extra"), *(x[c].alias(c) for c in ("words", "doc_id", "size", "times", "source", "source_size", "target", "passes", "block")))
        return F.struct((acc["need"] - F.when(fits, x["words"]).otherwise(0)).alias("need"), F.concat(acc["out"], F.array(row)).alias("out"))

    filled = F.aggregate("has", F.struct(F.col("need").cast("double").alias("need"), F.array().cast(kind).alias("out")), take)["out"]
    columns = ["rank", "block", "doc_id", "source", "size", "times", "source_size", "target", "passes", "extra"]
    rows = rows.where(F.col("extra").isNotNull()).select(columns).unionByName(cut.where(F.col("extra").isNotNull()).select(columns))
    rows = rows.unionByName(last.select("rank", F.inline(filled)).select(columns))

    # blocks of each pass, the last being those of which only some documents are taken
    turn = F.explode(F.sequence(F.lit(1), F.col("passes") + F.when(F.coalesce("extra", F.lit(1)) > 0, 1).otherwise(0)))
    drawn = blocks.where((F.col("passes") > 0) | F.col("extra").isNull() | (F.col("extra") > 0)).select("rank", "block", turn.alias("turn"))
    if shards is None:
        words = per.agg(F.sum("source_size").alias("n")).first().n or 0
        shards = max(LEAST_SHARDS, min(-(-words // SHARD_WORDS), drawn.count()))
    quotas = split_quotas(drawn.groupBy("rank").agg(F.count(F.lit(1)).alias("quota")), shards, seed + 5)
    end = F.sum("quota").over(Window.partitionBy("rank").orderBy("first"))
    spots = quotas.withColumn("end", end).select("rank", F.col("first").alias("shard"), F.explode(F.sequence(F.col("end") - F.col("quota") + 1, F.col("end"))).alias("place"))
    place = F.row_number().over(Window.partitionBy("rank").orderBy(F.xxhash64("rank", "block", "turn", F.lit(seed + 6)), "block", "turn")).cast("long")
    dealt = drawn.withColumn("place", place).join(spots, ["rank", "place"]).select("rank", "block", "turn", "shard")
    dealt = dealt.groupBy("rank", "block").agg(F.array_sort(F.collect_list(F.struct("turn", "shard")))["shard"].alias("block_shards"))
    copies = F.col("passes") + F.col("extra")
    rows = rows.join(dealt, ["rank", "block"], "left").withColumn("copies", copies).withColumn("again", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    taken = F.when(F.col("copies") > 0, F.slice("block_shards", 1, F.greatest("copies", F.lit(1)))).otherwise(F.array().cast("array<int>"))
    orders = F.transform("shards", lambda shard, copy: F.xxhash64("doc_id", "source", copy, F.lit(seed + 7)))
    rows = rows.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"), taken.alias("shards"))
    mixed = keep(rows.withColumn("orders", orders), "mix")
    discard(sizes, aims, blocks, quotas)
    return mixed


def shards_of(mixed: DataFrame) -> int:
    """How many shards the copies go to."""
    last = mixed.agg(F.max(F.array_max("shards")).alias("last")).first().last
    return 1 if last is None else last + 1


def deal(mixed: DataFrame, shards: int | None = None) -> DataFrame:
    """The mix itself, from rows with shards and orders: a row per copy with its shard and order, each shard's rows together and shuffled.

    Shards follow one another, and so do the parts of one, if there are fewer shards than a shuffle has partitions: orders are hashes, so each
    partition gets an equal stretch of them, whatever shards there are.
    """
    shards = shards or shards_of(mixed)
    parts = max(shards, int(mixed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = mixed.select("*", F.posexplode(F.arrays_zip("shards", "orders")).alias("copy", "to")).select("*", F.col("to.shards").alias("shard"), F.col("to.orders").alias("order")).drop("to")
    place = (F.col("shard") + F.col("order") / F.lit(float(1 << 64)) + F.lit(0.5)) / F.lit(float(shards))
    part = F.least(F.floor(place * F.lit(float(parts))), F.lit(parts - 1)).cast("int")
    return rows.repartitionById(parts, part).sortWithinPartitions("shard", "order", "copy")


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3, shards: int | None = None) -> DataFrame:
    """docs (with doc_id, text, source), each row as often as the mix takes it, dealt to shards and shuffled within them; columns stay as they are, whatever their names.

    Null texts have no words; they are taken with the blocks that they fall into. Null sources are a source, null ids ids like any other. Rows alike in id, source and size are
    taken alike, each as often. An empty table gives an empty result.
    """
    mixed = mix(docs, weights, most, shards).where("copies > 0").select("doc_id", "source", "size", "shards", "orders")
    shards, mixed = shards_of(mixed), mixed.distinct()
    size = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").alias("of_id"), F.col("source").alias("of_source"), size.alias("of_size"))
    same = F.col("of_id").eqNullSafe(F.col("doc_id")) & F.col("of_source").eqNullSafe(F.col("source")) & (F.col("of_size") == F.col("size"))
    return deal(rows.join(mixed, same).select("row", "shards", "orders"), shards).select("row.*")
