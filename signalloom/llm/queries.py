"""The queries of this subpackage, each applying one operator to its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalloom.llm.common import documents
from signalloom.llm.divergence import audit
from signalloom.llm.language_id import identify
from signalloom.llm.lattice_lm import score
from signalloom.llm.mixing import mix
from signalloom.llm.multiset_hash import edited_fingerprints
from signalloom.llm.oracle import SQL
from signalloom.llm.prefix_bpe import round_trip
from signalloom.llm.quality_rules import judge
from signalloom.llm.simhash import as_hex, near_duplicates
from signalloom.llm.spelling import variants
from signalloom.llm.suffix_dedup import remove_repeats
from signalloom.llm.token_counts import count_tokens
from signalloom.llm.vector_search import top_k
from signalloom.llm.wavelet import encode_and_read_back
from signalloom.session import ship


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), width=3).select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), every=50, k=5)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))


def op5_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(documents(spark, sf_dir))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir), size=400, words=51).drop("kept")


def op8_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_read_back(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


def op9_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op10_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(documents(spark, sf_dir))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(documents(spark, sf_dir))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir)).withColumn("failed", F.array_join("failed", " "))


OPERATORS = (
    op1_token_counts, op2_simhash, op3_top_k, op4_language_id, op5_multiset_hash, op6_mixing, op7_suffix_dedup, op8_wavelet, op9_lattice_lm, op10_prefix_bpe,
    op11_spelling, op12_divergence, op13_quality_rules,
)


def shipped(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: shipped(f) for f in OPERATORS}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
