"""The registered queries of this folder, and the SQL beside them."""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.llm import (
    alignment,
    bpe,
    embedding_dups,
    exact_dups,
    packing,
    pii,
    quality,
    resampling,
    secret_scan,
    simhash,
    substring,
    topk,
    urls,
)
from vecloom.llm.common import bounded_batches, spans_text, table
from vecloom.llm.oracle import ORACLE

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
QUERIES: dict = {}
__all__ = ["BYTE_BPE", "ORACLE", "QUERIES"]


def registered(query):
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return query(spark, sf_dir)

    QUERIES[query.__name__] = run
    return run


@registered
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    trip = bpe.round_trip(BYTE_BPE)
    found = table(spark, sf_dir, "documents").select("doc_id", trip(F.col("text")).alias("t"))
    return found.select(
        "doc_id",
        F.size("t.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("t.ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("t.decoded", 256).alias("decoded_sha256"),
    )


@registered
def op2_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find(table(spark, sf_dir, "documents")))


@registered
def op3_url_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


@registered
def op4_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@registered
def op5_token_efficiency_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = secret_scan.encoding_file(RANKS)
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", secret_scan.find(ranks, public_tokenizers.PATTERN, F.col("text")).alias("f"))

    def many(kind: str):
        return F.size(F.filter("f.base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *(many(kind).alias(f"n_{kind}") for kind in secret_scan.BASE),
        F.sha2(spans_text(F.col("f.base")), 256).alias("base_sha256"),
        spans_text(F.col("f.spans")).alias("spans"),
    )


@registered
def op6_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(docs, labels.where(~quality.held_out(F.col("doc_id"))))
    found = docs.select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), quality.score(model, F.col("text")).alias("score")
    )
    return found.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@registered
def op7_hyperplane_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dups.near_duplicates(table(spark, sf_dir, "embeddings"))


@registered
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), BYTE_BPE)


@registered
def op9_fm_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@registered
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


@registered
def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dups.find_copies(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("digest", "text_sha256")


@registered
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align(table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@registered
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")
