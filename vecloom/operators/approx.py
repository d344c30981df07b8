"""Approximate top-k: score only the vectors that share a cell with the query.

Two ways to assign cells, one way to search them. Both take a table of stored cell
numbers, so cells are computed once per vector, not once per query.

* Hyperplanes: ``tables`` independent hashes of ``bits`` sign bits. The planes come
  from a rule, so every run and every engine gets the same cells.
* Clusters: nearest of ``num_cells`` k-means centres; a query probes its nearest few.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.functions.vectors import SCORE_DIGITS
from vecloom.operators import cells as cell_search
from vecloom.operators.kernel import to_matrix
from vecloom.operators.search import (
    BROADCAST_BYTES,
    QueryBlock,
    check_k,
    check_metric,
    hit_schema,
    merge_best,
    packed,
    query_size,
    scan_best,
    search_in_blocks,
)

CELLS = T.ArrayType(T.IntegerType())
# Centres are held by every task: 16,384 x 384 doubles are 50 MB.
MAX_CENTRES = 1 << 14
# Distances held at once while rows are placed: 4 M doubles are 32 MB.
SCORES_AT_ONCE = 4_000_000


def plane_signs(dim: int, tables: int, bits: int) -> np.ndarray:
    """Hyperplanes as +1/-1, shape (tables, bits, dim): the sign is + when the first
    hex digit of md5('table:bit:dimension') is even."""
    return np.array(
        [
            [
                [
                    1.0 if int(hashlib.md5(f"{t}:{b}:{d}".encode()).hexdigest()[0], 16) % 2 == 0
                    else -1.0
                    for d in range(dim)
                ]
                for b in range(bits)
            ]
            for t in range(tables)
        ]
    )


def _add_cells(df: DataFrame, assign, column: str) -> DataFrame:
    """Append ``column`` ARRAY<INT>, computed per Arrow block by ``assign(matrix)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            numbers = assign(to_matrix(batch.column("embedding"))).astype(np.int32)
            offsets = np.arange(len(numbers) + 1, dtype=np.int32) * np.int32(numbers.shape[1])
            array = pa.ListArray.from_arrays(pa.array(offsets), pa.array(numbers.reshape(-1)))
            yield batch.append_column(column, array)

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(column, CELLS)]))


def hyperplane_cells(
    df: DataFrame, dim: int, tables: int = 8, bits: int = 6, column: str = "cells"
) -> DataFrame:
    """One cell per hash table: ``table * 2**bits + sign bits``."""
    if tables * (1 << bits) > cell_search.MAX_CELLS:
        raise ValueError(f"tables * 2**bits must be at most {cell_search.MAX_CELLS}")
    planes = plane_signs(dim, tables, bits).reshape(tables * bits, dim)
    weights = 1 << np.arange(bits)

    def assign(matrix: np.ndarray) -> np.ndarray:
        # Rounding settles a projection of zero the same way in any summing order.
        side = np.round(matrix @ planes.T, SCORE_DIGITS) >= 0
        number = (side.reshape(len(matrix), tables, bits) * weights).sum(axis=2)
        return number + np.arange(tables) * (1 << bits)

    return _add_cells(df, assign, column)


def fit_centres(
    corpus: DataFrame, num_cells: int, seed: int = 42, share: float = 1.0
) -> np.ndarray:
    """k-means centres, fitted by MLlib on every row, or on the hash-chosen ``share`` of
    the rows that the caller asks for."""
    if not 0 < share <= 1:
        raise ValueError(f"share must be above 0 and at most 1, got {share}")
    if not 1 <= num_cells <= MAX_CENTRES:
        raise ValueError(f"num_cells must be between 1 and {MAX_CENTRES}, got {num_cells}")
    part = corpus
    if share < 1.0:
        part = corpus.where(F.xxhash64("id") < int((share - 0.5) * 2.0**64))
    features = part.select(array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    model = KMeans(k=num_cells, seed=seed, maxIter=10).fit(features)
    return np.array(model.clusterCenters())


def nearest_cells(
    df: DataFrame, centres: np.ndarray, probes: int = 1, column: str = "cells"
) -> DataFrame:
    """The nearest ``probes`` centres of each vector."""
    if not 1 <= probes <= len(centres):
        raise ValueError(f"probes must be between 1 and {len(centres)}, got {probes}")
    half_norms = (centres * centres).sum(axis=1) / 2

    step = max(1, SCORES_AT_ONCE // len(centres))

    def nearest(matrix: np.ndarray) -> np.ndarray:
        closeness = matrix @ centres.T - half_norms
        if probes == 1:
            return closeness.argmax(axis=1)[:, None]
        return np.argsort(-closeness, axis=1, kind="stable")[:, :probes]

    def assign(matrix: np.ndarray) -> np.ndarray:
        return np.concatenate(
            [nearest(matrix[start : start + step]) for start in range(0, len(matrix), step)]
        )

    return _add_cells(df, assign, column)


def top_k_in_cells(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    *,
    num_cells: int,
    metric: str = "ip",
    carry: tuple[str, ...] = (),
    exclude_self: bool = False,
    limit_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Best ``k`` among the vectors sharing a cell with the query. Both sides have a
    ``cells`` column. A small query set rides along with the corpus scan; a large one
    meets the corpus cell by cell."""
    check_k(k)
    check_metric(metric)
    wanted = k + 1 if exclude_self else k
    schema = hit_schema(queries, corpus, carry)
    asked = queries.select("query_id", "embedding", F.col("cells").alias("probes"))
    size = query_size(asked)

    def finish(hits: DataFrame, in_parts: bool = True) -> DataFrame:
        if exclude_self:
            hits = hits.where(F.col("id") != F.col("query_id").cast(schema["id"].dataType))
        return merge_best(hits, k, repeated=True, in_parts=in_parts).select("query_id", "rank", "id", *carry, "score")

    if limit_bytes:
        def find(block: QueryBlock, stored: DataFrame) -> DataFrame:
            if "cell" in stored.columns and block.probes:
                # A partition column: folders of cells no query probes are not read.
                probed = np.unique(np.concatenate(block.probes)).tolist()
                stored = stored.where(F.col("cell").isin(probed))
            return scan_best(stored, block, wanted, schema, metric=metric, carry=carry, cell="cells")

        needed = ["id", *carry, "embedding", "cells", *(["cell"] if "cell" in corpus.columns else [])]
        stored = corpus.select(*dict.fromkeys(needed))
        return search_in_blocks(asked, stored, size, wanted, limit_bytes, find, finish)
    return finish(
        cell_search.best_in_cells(
            queries.withColumn("cell", F.explode("cells")),
            corpus if "cell" in corpus.columns else corpus.withColumn("cell", F.explode("cells")),
            wanted,
            schema,
            metric=metric,
            carry=carry,
            num_cells=num_cells,
            dim=size[1],
        )
    )


def write_hyperplane_index(
    corpus: DataFrame, path: str, dim: int, tables: int, bits: int
) -> None:
    """The corpus with its hyperplane cells, and the settings that made them."""
    settings = corpus.sparkSession.createDataFrame(
        [(dim, tables, bits)], "dim int, tables int, bits int"
    )
    settings.write.mode("overwrite").parquet(f"{path}/settings")
    indexed = hyperplane_cells(packed(corpus), dim, tables, bits)
    indexed.write.mode("overwrite").parquet(f"{path}/vectors")


def search_hyperplane_index(
    queries: DataFrame, path: str, k: int, **options: object
) -> DataFrame:
    spark = queries.sparkSession
    made = spark.read.parquet(f"{path}/settings").first()
    return top_k_in_cells(
        hyperplane_cells(queries, made.dim, made.tables, made.bits),
        spark.read.parquet(f"{path}/vectors"),
        k,
        num_cells=made.tables << made.bits,
        **options,
    )


def write_cluster_index(
    corpus: DataFrame, path: str, centres: np.ndarray, share: float | None = None
) -> None:
    """The centres, and the corpus in one folder per cell. A cell that holds most of the
    rows is split into many files by the rebalance."""
    if len(centres) > MAX_CENTRES:
        raise ValueError(f"at most {MAX_CENTRES} centres, got {len(centres)}")
    settings = corpus.sparkSession.createDataFrame(
        [(len(centres), share)], "num_cells int, fitted_share double"
    )
    settings.write.mode("overwrite").parquet(f"{path}/settings")
    rows = [(cell, [float(x) for x in centre]) for cell, centre in enumerate(centres)]
    schema = "cell int, centre array<double>"
    corpus.sparkSession.createDataFrame(rows, schema).write.mode("overwrite").parquet(
        f"{path}/centres"
    )
    placed = nearest_cells(packed(corpus), centres).withColumn("cell", F.get("cells", F.lit(0))).drop("cells")
    placed.hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(
        f"{path}/vectors"
    )


def search_cluster_index(
    queries: DataFrame, path: str, k: int, probes: int, **options: object
) -> DataFrame:
    """Top-k over the nearest ``probes`` cells of each query."""
    spark = queries.sparkSession
    stored = spark.read.parquet(f"{path}/centres").orderBy("cell").collect()
    centres = np.array([row.centre for row in stored])
    corpus = spark.read.parquet(f"{path}/vectors").withColumn("cells", F.array("cell"))
    return top_k_in_cells(
        nearest_cells(queries, centres, min(probes, len(centres))),
        corpus,
        k,
        num_cells=len(centres),
        **options,
    )


def recall(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """``(query_id, n_exact, n_found, recall)``: the share of each query's exact rows
    that the approximate search returned."""
    pair = ["query_id", "id"]
    found = approximate.select(*pair).withColumn("hit", F.lit(1))
    return (
        exact.select(*pair)
        .join(found, pair, "left")
        .groupBy("query_id")
        .agg(F.count(F.lit(1)).alias("n_exact"), F.count("hit").alias("n_found"))
        .withColumn("recall", F.col("n_found") / F.col("n_exact"))
    )
