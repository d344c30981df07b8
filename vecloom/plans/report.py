"""Metric lines, run reports and the tables made from them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vecloom.operators.quantiles import index_quantiles

METRIC_SCHEMA = (
    "stage string, duration_s double, throughput double, throughput_unit string, "
    "worker_count int, extra map<string,string>"
)
LATENCY_SHARES = {"p50": 0.5, "p95": 0.95}


def throughput(rows: Column | str, seconds: Column | str) -> Column:
    """Rows per second; 0 when no time was measured."""
    count = F.col(rows) if isinstance(rows, str) else rows
    return F.coalesce(F.try_divide(count.cast("double"), seconds), F.lit(0.0))


def metric_line(
    spark: SparkSession,
    stage: str,
    duration_s: float,
    *,
    throughput: float | None = None,
    throughput_unit: str | None = None,
    worker_count: int | None = None,
    extra: Mapping[str, object] | None = None,
) -> DataFrame:
    """One metric row of a stage that just ran."""
    texts = {name: str(value) for name, value in (extra or {}).items()}
    row = (stage, duration_s, throughput, throughput_unit, worker_count, texts)
    return spark.createDataFrame([row], METRIC_SCHEMA)


def append_metrics(rows: DataFrame, path: str) -> None:
    """Append metric rows as JSON lines."""
    rows.write.mode("append").json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRIC_SCHEMA).json(path)


def shard_stats(vectors: DataFrame) -> DataFrame:
    """Per shard: vectors, distinct articles and raw size (4 bytes per float)."""
    return vectors.groupBy("shard_id").agg(
        F.count(F.lit(1)).alias("num_vectors"),
        F.countDistinct("article_id").alias("num_articles"),
        (F.sum(F.size("embedding")) * 4).alias("raw_bytes"),
    )


def shard_counts(vectors: DataFrame, dim: int) -> DataFrame:
    """:func:`shard_stats` of vectors of one known dimension, which are not read."""
    return vectors.groupBy("shard_id").agg(
        F.count(F.lit(1)).alias("num_vectors"),
        F.countDistinct("article_id").alias("num_articles"),
        (F.count(F.lit(1)) * dim * 4).alias("raw_bytes"),
    )


def stored_size(spark: SparkSession, path: str) -> DataFrame:
    """``(n_files, total_bytes)`` of a folder, from the file listing alone."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length")
    )
    return files.agg(
        F.count(F.lit(1)).alias("n_files"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"),
    )


def shard_sizes(spark: SparkSession, path: str) -> DataFrame:
    """``(shard_id, n_files, stored_bytes)`` of a folder of shard folders, from the listing."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(F.regexp_extract("path", r"/shard_id=(\d+)/", 1).alias("shard"), "length")
    )
    return (
        files.where("shard <> ''")
        .groupBy(F.col("shard").cast("int").alias("shard_id"))
        .agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("stored_bytes"))
    )


def run_report(stats: DataFrame, run: Mapping[str, object]) -> DataFrame:
    """One row for a run: its settings and totals, and the per-shard stats as an array
    (one entry per shard)."""
    settings = [F.lit(value).alias(name) for name, value in run.items()]
    entry = F.struct(*stats.columns)
    return stats.agg(
        F.sum("num_vectors").alias("num_paragraphs"),
        F.count(F.lit(1)).alias("num_shards_with_data"),
        F.array_sort(F.collect_list(entry)).alias("shard_stats"),
    ).select(*settings, "num_paragraphs", "num_shards_with_data", "shard_stats")


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)


def latency_stats(durations: DataFrame, value: str, *groups: str) -> DataFrame:
    """Count, mean, p50 and p95. A quantile is the sorted list's element at
    ``floor(n * share)``: the upper median, and the maximum for p95 of ten."""
    return index_quantiles(durations, value, LATENCY_SHARES, *groups)


def worker_scaling(runs: DataFrame, *stage: str) -> DataFrame:
    """Throughput per stage and worker count, its speed-up over the fewest workers, and
    whether it is the peak. ``runs`` has ``worker_count``, ``num_rows`` and
    ``duration_s``; the windows see one row per stage and worker count."""
    totals = runs.groupBy(*stage, "worker_count").agg(
        F.sum("num_rows").alias("num_rows"), F.sum("duration_s").alias("duration_s")
    )
    whole = Window.partitionBy(*stage)
    base = F.first("throughput").over(whole.orderBy("worker_count"))
    best = F.max_by("worker_count", "throughput").over(whole)
    return (
        totals.withColumn("throughput", throughput("num_rows", "duration_s"))
        .withColumn("speedup", F.coalesce(F.try_divide("throughput", base), F.lit(0.0)))
        .withColumn("is_peak", F.col("worker_count") == best)
        .drop("duration_s")
    )


def compare_settings(stats: DataFrame, backend: str, mode: str, modes: list[str]) -> DataFrame:
    """Mean, p50 and p95 per backend, one column group per mode. ``stats`` has one row
    per backend and mode."""
    return (
        stats.groupBy(backend)
        .pivot(mode, modes)
        .agg(
            F.first("mean").alias("mean"),
            F.first("p50").alias("p50"),
            F.first("p95").alias("p95"),
        )
    )


def by_length(texts: DataFrame, text: str) -> DataFrame:
    return texts.withColumn(f"{text}_length", F.length(text))


def longest(texts: DataFrame, text: str, key: str, rows: int = 20) -> DataFrame:
    """The longest texts, longest first."""
    length = f"{text}_length"
    return (
        by_length(texts, text)
        .select(key, length)
        .orderBy(F.col(length).desc(), F.col(key).asc())
        .limit(rows)
    )
