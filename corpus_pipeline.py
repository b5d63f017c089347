"""A corpus pipeline of five stages, each on all that its predecessor kept.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame.  Each result is written as Parquet to the shared
folder and read again as the next stage's ``docs``, so a lost executor costs one stage's tasks at most.  All but the last return
the columns of ``documents``.

language    documents that language ID rejects go: no letters, or no language that fits (score under LEAST_SCORE)
near        one row of each group of near copies stays, that of the smallest id (five-word shingles, similarity 0.8)
repeats     later copies of strings of 200 bytes that occur earlier in the corpus are cut out; a document of which nothing is left goes
mix         sources are mixed to weights 1, 2, 3 by code point, at most three copies of a document; the copy in which a quota ends is cut; copies
            lie in the shards that the splitting tree deals
tokens      byte-level BPE ids of each text of the mix, and the digest of what they decode to
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from priceloom.llm import bpe, language, minhash, mixing, suffix
from priceloom.llm.common import materialize

#: A text passes language ID if its best language has this share of the (tempered) posterior.
LEAST_SCORE = 0.35
RANKS = "byte_bpe_multi_50k.tiktoken"
#: SQL can express neither the language model nor the merges; tests hold the stages against brute force.
ORACLE_SQL = None


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = language.predict(docs, language.fit(docs), lang_to="__lang", score_to="__score")
    return scored.filter((F.col("__lang") != "und") & (F.col("__score") >= LEAST_SCORE)).drop("__lang", "__score")


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.drop_near_duplicates(docs, width=5, percent=80, one_row=True)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(docs, length=200, keep="first").filter(F.col("text") != "")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip_documents(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [("language", keep_languages), ("near", keep_one_of_near_copies), ("repeats", cut_repeats), ("mix", mix), ("tokens", tokenize)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
