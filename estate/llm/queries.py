"""Registered queries of the training-data operators: each applies one
operator, with production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estate.llm import (byte_bpe, decontaminate, minhash_forest, piece_bpe, pivot_topk, ranked_search, secret_scan, suffix_dedup, token_counts,
                        url_rules, vector_codes, weak_quality, window_dedup)
from estate.llm._ship import table


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_forest.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = byte_bpe.decode(byte_bpe.encode(docs, path), path)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(byte_bpe.ids_text(F.col("ids")), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_topk.top_k(table(spark, sf_dir, "embeddings"), k=5, is_query=F.col("vec_id") % 50 == 0)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("byte_bpe_50k.json"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.array_distinct(F.filter(F.transform("leaks", lambda x: x["item_id"]), lambda i: i.isNotNull())))
    return found.select("doc_id", items.alias("item_ids"), F.size("leaks").cast("long").alias("n_regions"),
                        (F.size("leaks") > 0).alias("contaminated"))


def _listed(spans) -> "F.Column":
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def counted(kind: str):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == F.lit(kind)))).cast("long").alias(f"n_{kind}")
    counts = [counted(k) for k in secret_scan.KINDS]
    return found.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"),
                        _listed(F.col("spans")).alias("spans"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = window_dedup.remove_earlier(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge_urls(pages).select("page_id", "host", "path", "rule", "pattern", "verdict")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    coded = piece_bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, decoded_col="decoded")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(piece_bpe.ids_text(F.col("ids")), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"),
                        piece_bpe.covered(F.col("cuts")).alias("span_bytes"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = vector_codes.compress(table(spark, sf_dir, "embeddings"), keep=("label",))
    rows = vector_codes.with_group_error(codes.rows, "label")
    return rows.select("vec_id", vector_codes.code_text("codes").alias("code"), "error", "label_error",
                       F.lit(vector_codes.codebooks_sha256(codes)).alias("codebooks_sha256"))


QUERIES = {f.__name__: f for f in (op1_minhash_dedup, op2_byte_bpe, op3_weak_quality, op4_pivot_topk, op5_token_counts,
                                    op6_decontamination, op7_secret_scan, op8_suffix_dedup, op9_substring_dedup,
                                    op10_url_filters, op11_ranked_search, op12_sentencepiece, op13_vector_codes)}
