"""Corpus cleaning pipeline over ``documents``.

Five stages, each over everything that its predecessor kept, written as Parquet
in the cluster's shared folder and read again:

1. ``quality``: documents that the weak-label classifier rejects go;
2. ``near_duplicates``: one document of each group of near copies stays (word
   shingles of five words, similarity 0.8 or more);
3. ``decontamination``: documents that leak a benchmark item go;
4. ``secrets``: secrets, also wrapped ones, are masked in the text;
5. ``tokens``: texts are encoded, decoded and compared.

The first four return the columns of ``documents``; ``n_chars`` follows the text.
The last returns ``doc_id, lang, source, n_chars, n_tokens, ids, exact``.
Null and empty texts pass through all stages and give no tokens.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estate.llm import byte_bpe, decontaminate, minhash_forest, secret_scan, weak_quality
from estate.llm._ship import release, stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return weak_quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_forest.drop_near_duplicates(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = secret_scan.redact_secrets(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.char_length("text").cast(dict(docs.dtypes)["n_chars"]))
    return masked


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = byte_bpe.decode(byte_bpe.encode(docs, path), path)
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return coded.select("doc_id", "lang", "source", "n_chars", F.size("ids").cast("long").alias("n_tokens"), "ids",
                        same.alias("exact"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("secrets", secrets), ("tokens", tokens)]

# the classifier is fitted by iteration, which SQL can't express: the stages are
# tested one by one against brute force (tests/llm/test_pipeline.py)
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        release(spark)
    return docs
