"""Small helpers the operators of this folder share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.session import run_dir

BATCH_ROWS = 2000
# What a task of a bucketed table reads at most, on average.
BUCKET_BYTES = 256 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most BATCH_ROWS rows from here on in this session. The default of
    10,000 texts is held by a task several times over, in Python and beside the JVM's heap."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def bucketed(rows: DataFrame, key: str, size: int = 0) -> DataFrame:
    """The rows as a written table bucketed by ``key``: joins on it do not shuffle them again.

    An external table in the shared folder, with as many buckets as the session's shuffles
    have partitions, and more where ``size``, the bytes it will have, asks for them. Its entry
    in the catalog goes at once; the files stay as long as other intermediates.
    """
    spark = rows.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    path = run_dir(spark, "bucketed")
    name = "t" + path.rsplit("-", 1)[1]
    rows.repartition(buckets, key).write.bucketBy(buckets, key).option("path", path).saveAsTable(name)
    made = spark.table(name)
    made.schema  # resolved: the files and buckets are known from here on
    spark.sql(f"DROP TABLE {name}")
    return made


def written(rows: DataFrame, label: str) -> DataFrame:
    """The rows as a written table, tightly compressed: for texts that are read again."""
    path = run_dir(rows.sparkSession, label)
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column as UTF-8 bytes and the place of each row in them; null is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans_text(spans: Column) -> Column:
    """Sorted spans (start, place of the kind, kind, end) as kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
