"""The given tables in the roles the library works with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.session import spread
from vecloom.sources.chunking import to_paragraphs

NUM_SHARDS = 4
# Shards for a key with ten values, so that some hold nothing.
SPARSE_SHARDS = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored vectors: four to an article, titled by label."""
    article = F.expr("vec_id div 4")
    return table(spark, sf_dir, "embeddings").select(
        F.concat_ws("_", article, F.pmod("vec_id", F.lit(4))).alias("paragraph_id"),
        article.alias("article_id"),
        F.concat(F.lit("label "), F.col("label")).alias("article_title"),
        "embedding",
    )


def scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same vectors times their label: lengths from 0 to 9."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.transform(
            "embedding", lambda x: (x.cast("double") * F.col("label")).cast("float")
        ).alias("embedding"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents in enough tasks for per-text work; the given table is one file."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return spread(rows, "doc_id")


def paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_paragraphs(documents(spark, sf_dir), "doc_id", "text", "source")


def benchmark_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("b"), F.col("item_id")).alias("query_id"), "text"
    )


def micro(vector: str) -> Column:
    """A vector as text in millionths, to compare it as one value."""
    whole = F.transform(vector, lambda x: F.round(x.cast("double") * 1e6).cast("bigint"))
    return F.array_join(whole.cast("array<string>"), ",")
