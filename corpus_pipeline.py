"""A pipeline over documents: each stage works on all that the one before it kept.

Documents in no known language go; of near copies one stays; passages that also stand elsewhere are cut out; sources
are mixed to their target weights; and what is left is encoded and decoded.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalloom.llm.common import discard, keep
from signalloom.llm.language_id import only_known
from signalloom.llm.mixing import mixed_documents
from signalloom.llm.prefix_bpe import encoded
from signalloom.llm.simhash import drop_near_copies
from signalloom.llm.suffix_dedup import cut_repeats
from signalloom.session import ship

#: Distinct pieces that a worker remembers while it encodes: fewer than for encoding alone, since the stages before leave executors with less memory. Ids don't depend on it.
REMEMBERED = 150_000
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a learned language; those without letters, or not surely of any language, are rejected."""
    ship(spark)
    return only_known(docs.select(COLUMNS), least=0.5)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    ship(spark)
    return drop_near_copies(docs.select(COLUMNS), width=5, similarity=0.8)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts less each passage of over 50 words that also stands elsewhere; documents of which no word is left go."""
    ship(spark)
    return cut_repeats(docs.select(COLUMNS), words=51)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, once for each copy."""
    ship(spark)
    return mixed_documents(docs.select(COLUMNS))


def byte_pairs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, and digests of them and of what they decode to."""
    ship(spark)
    return encoded(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, remembered=REMEMBERED).select("doc_id", F.col("source"), "ids", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("language identification", known_languages),
    ("near copies", one_of_near_copies),
    ("repeated passages", without_repeats),
    ("mixing", mixed),
    ("byte-pair encoding", byte_pairs),
]

#: Stages whose result is read once at most.
READ_ONCE = {"mixing", "byte-pair encoding"}

#: The stages learn models, sort suffixes and encode texts, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, from the documents table. What a stage reads again and again is written once; the mix is read once, by the stage behind it."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name not in READ_ONCE:
            docs = keep(docs, "pipeline")
            if before is not None:
                discard(before)
            before = docs
    return docs
