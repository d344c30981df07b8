"""Top-k within matching cells, as bounded tasks.

A cell is an integer both sides share: one cell for exact search, a hash bucket or a
cluster for approximate search. A cell may hold a third of all rows, so each cell is
cut into a grid: its vectors into blocks by a hash of their id, its queries into
blocks likewise, and every (vector block, query block) pair becomes one cogrouped
task of bounded size. Each task emits at most ``k`` rows per query.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.operators.kernel import BestRows, hits_table, to_matrix
from vecloom.session import settled

# Largest block of each side, in bytes of float64. A task holds one of each, a few times over.
VECTOR_BYTES = 32 * 1024 * 1024
QUERY_BYTES = 8 * 1024 * 1024
# A side smaller than this is not cut further to occupy idle cores.
SMALL_BLOCK = 4_096
MAX_CELLS = 1 << 18


def _blocks(count: Column, size: int, tasks: int = 1) -> Column:
    """How many blocks: enough for their size, and for ``tasks`` where rows suffice."""
    occupying = F.least(F.lit(tasks), F.ceil(count / SMALL_BLOCK))
    return F.greatest(F.ceil(count / size), occupying).cast("int")


def _block_of(key: str, blocks: Column) -> Column:
    # A hash, not a random number: a task that is run again gets the same rows.
    return F.pmod(F.xxhash64(key), blocks).cast("int")


def best_in_cells(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    schema: T.StructType,
    *,
    metric: str = "ip",
    carry: tuple[str, ...] = (),
    num_cells: int = 1,
    dim: int,
    vector_bytes: int = VECTOR_BYTES,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """Partial hits of queries and vectors of ``dim`` elements that share a ``cell``.

    Vectors in a cell no query asks for drop out before the shuffle.
    """
    if num_cells > MAX_CELLS:
        raise ValueError(f"at most {MAX_CELLS} cells, got {num_cells}")
    vector_block, query_block = (max(1, size // (8 * max(1, dim))) for size in (vector_bytes, query_bytes))
    names = ["id", *carry]
    asked = queries.groupBy("cell").agg(_blocks(F.count(F.lit(1)), query_block).alias("q_blocks"))
    cores = corpus.sparkSession.sparkContext.defaultParallelism
    tasks = -(-2 * cores // num_cells)
    held = corpus.groupBy("cell").agg(
        _blocks(F.count(F.lit(1)), vector_block, tasks).alias("v_blocks")
    )
    # One row per cell; Spark broadcasts it if its measured size allows.
    grid = settled(asked.join(held, "cell"), "grid")
    left = (
        queries.join(grid, "cell")
        .withColumn("q_block", _block_of("query_id", F.col("q_blocks")))
        .withColumn("v_block", F.explode(F.sequence(F.lit(0), F.col("v_blocks") - 1)))
        # Fresh names: the queries are often a projection of the corpus itself.
        .select("cell", "q_block", "v_block", "query_id", F.col("embedding").alias("asked"))
    )
    right = (
        corpus.join(grid, "cell")
        .withColumn("v_block", _block_of("id", F.col("v_blocks")))
        .withColumn("q_block", F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1)))
        .select("cell", "q_block", "v_block", *names, "embedding")
    )

    def search(asking: pa.Table, stored: pa.Table) -> pa.Table:
        rows = stored.select(names)
        best = BestRows(to_matrix(asking.column("asked")), k, metric)
        if asking.num_rows and stored.num_rows:
            best.offer(rows, to_matrix(stored.column("embedding"), best.dim))
        return hits_table(best, asking.column("query_id"), rows)

    keys = ["cell", "q_block", "v_block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, schema)

