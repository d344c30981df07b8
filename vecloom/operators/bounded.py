"""Exact search that leaves out what cannot be among the best.

Vectors lie in blocks around centres, each block a folder, and a small table holds for every
block its centre and the distance of its farthest vector. No vector of a block can score more
with a query than the centre does plus that distance times the query's length. A search reads
the most promising blocks first, which gives every query a k-th best score, and then only the
blocks whose bound comes up to it. The rows are those of the plain scan; what is saved depends
on how far the vectors cluster.

Blocks hold about BLOCK_ROWS rows: a centre with more of them has more blocks, dealt by a hash
of the id, so a centre that holds most of the rows is many blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.operators import approx
from vecloom.operators.kernel import to_matrix
from vecloom.operators.search import (
    BROADCAST_BYTES,
    check_k,
    check_metric,
    exact_top_k,
    fetch_block,
    fits,
    merge_best,
    packed,
    query_size,
)
from vecloom.session import settled

BLOCK_ROWS = 1 << 14
# Scores are told apart at nine digits; a bound this close counts as reached.
SLACK = 1e-6


def _unit(matrix: np.ndarray) -> np.ndarray:
    length = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return np.divide(matrix, length, out=np.zeros_like(matrix), where=length > 0)


def write_bounded(corpus: DataFrame, path: str, centres: np.ndarray) -> None:
    """The vectors in blocks, the centres and the blocks' bounds."""
    spark = corpus.sparkSession
    rows = [(cell, [float(x) for x in centre]) for cell, centre in enumerate(centres)]
    spark.createDataFrame(rows, "cell int, centre array<double>").write.mode("overwrite").parquet(f"{path}/centres")
    placed = approx.nearest_cells(packed(corpus), centres).withColumn("cell", F.get("cells", F.lit(0))).drop("cells")
    placed = settled(placed, "placed")
    pieces = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("pieces"))
    # One row for each centre.
    dealt = placed.join(F.broadcast(pieces), "cell").withColumn(
        "block", F.shiftleft(F.col("cell").cast("bigint"), 32) + F.pmod(F.xxhash64("id"), "pieces")
    )
    dealt.drop("pieces").hint("rebalance", "block").write.mode("overwrite").partitionBy("block").parquet(
        f"{path}/vectors"
    )

    def farthest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                matrix = to_matrix(batch.column(1), centres.shape[1]).astype(np.float64)
                centre = centres[(batch.column(0).to_numpy() >> 32)]
                apart = [np.sqrt(((m - centre) ** 2).sum(axis=1)) for m in (matrix, _unit(matrix))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(apart[0]), pa.array(apart[1])], ["block", "ip", "cosine"]
                )

    stored = spark.read.parquet(f"{path}/vectors").select(F.col("block").cast("bigint").alias("block"), "embedding")
    apart = stored.mapInArrow(farthest, "block bigint, ip double, cosine double")
    bounds = apart.groupBy("block").agg(
        F.count(F.lit(1)).alias("n"), F.max("ip").alias("ip"), F.max("cosine").alias("cosine")
    )
    bounds.write.mode("overwrite").parquet(f"{path}/bounds")


class Bounds:
    """What no vector of a block can score above, for each query and block."""

    def __init__(self, path: str, queries: np.ndarray, metric: str, spark) -> None:
        # One row for each block, and for each centre.
        found = spark.read.parquet(f"{path}/bounds").orderBy("block").toArrow()
        centres = np.array([r.centre for r in spark.read.parquet(f"{path}/centres").orderBy("cell").collect()])
        self.blocks = found.column("block").to_numpy()
        self.rows = found.column("n").to_numpy()
        queries = queries.astype(np.float64)
        if metric == "cosine":
            queries = _unit(queries)
        length = np.sqrt((queries * queries).sum(axis=1))
        self.most = queries @ centres[self.blocks >> 32].T + np.outer(length, found.column(metric).to_numpy())
        self.most += SLACK * np.maximum(1.0, np.abs(self.most))

    def promising(self, k: int) -> np.ndarray:
        """Blocks that hold k rows for each query, those with the highest bounds."""
        order = np.argsort(-self.most, axis=1, kind="stable")
        before = np.cumsum(self.rows[order], axis=1) - self.rows[order]
        return np.unique(order[before < k])

    def reached(self, least: np.ndarray) -> np.ndarray:
        """Blocks that may hold a row of at least a query's score."""
        return np.flatnonzero((self.most >= least[:, None]).any(axis=0))


def search_bounded(
    queries: DataFrame,
    path: str,
    k: int,
    *,
    metric: str = "ip",
    carry: tuple[str, ...] = (),
    exclude_self: bool = False,
    limit_bytes: int = BROADCAST_BYTES,
    read: list | None = None,
) -> DataFrame:
    """The rows of :func:`exact_top_k`. Query sets too large for one block, which together
    need most blocks anyway, scan them all. ``read`` is given the blocks of both steps."""
    check_k(k)
    check_metric(metric)
    spark = queries.sparkSession
    vectors = spark.read.parquet(f"{path}/vectors")
    common = {"metric": metric, "carry": carry, "exclude_self": exclude_self}
    size = query_size(queries)
    if not size[0] or not fits(size, k + 1, limit_bytes):
        return exact_top_k(queries, vectors, k, **common)
    held = fetch_block(queries, size)
    bounds = Bounds(path, held.matrix, metric, spark)
    first = bounds.promising(k + 1)

    def best_of(chosen: np.ndarray) -> DataFrame:
        inside = vectors.where(F.col("block").isin(bounds.blocks[chosen].tolist()))
        return exact_top_k(queries, inside, k, size=size, **common)

    hits = settled(best_of(first), "promising")
    last = {r.query_id: r.score for r in hits.where(F.col("rank") == k).select("query_id", "score").collect()}
    least = np.array([last.get(i, -np.inf) for i in held.ids.to_pylist()])
    rest = np.setdiff1d(bounds.reached(least), first)
    if read is not None:
        read += [bounds.blocks[first].tolist(), bounds.blocks[rest].tolist()]
    if not len(rest):
        return hits
    both = hits.drop("rank").unionByName(best_of(rest).drop("rank"))
    return merge_best(both, k).select("query_id", "rank", "id", *carry, "score")
