"""The queries of this subpackage, one per operator, over its whole table; their SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from priceloom.llm import bitslice, bpe, language, minhash, mixing, neighbours, sharding, suffix, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    sized = mixing.materialize(docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")), "mix-sizes")
    return mixing.query_columns(mixing.mix_sources(sized))


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), width=3, percent=85)


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, least_blocks=32)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = language.held_out(F.col("doc_id"))
    model = language.fit(docs.filter(~out))
    return language.predict(docs.select("doc_id", out.alias("held_out"), "text"), model).drop("text")


def op7_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.archive_path(spark)
    warc.write_pages(_table(spark, sf_dir, "pages"), path)
    return warc.read_pages(spark, path)


def op8_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(_table(spark, sf_dir, "documents"), length=200, keep="none", digest=True)


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitslice.top_k(_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op10_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = sharding.even_tree(16)
    return sharding.shard_documents(_table(spark, sf_dir, "documents"), tree, sharding.grow(tree, 16))


def queries() -> dict:
    return {f.__name__: f for f in (op1_token_counts, op2_mix_sources, op3_bpe_round_trip, op4_near_duplicates, op5_nearest_neighbours, op6_language, op7_warc_round_trip, op8_repeated_strings, op9_exact_top_k, op10_shard_documents)}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_mix_sources": mixing.MIX_SQL, "op4_near_duplicates": minhash.NEAR_SQL, "op7_warc_round_trip": warc.PAGES_SQL, "op8_repeated_strings": suffix.REPEATS_SQL,
        "op9_exact_top_k": bitslice.TOP_SQL, "op10_shard_documents": sharding.SHARD_SQL,
    }
