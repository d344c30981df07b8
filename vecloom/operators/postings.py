"""Approximate top-k by bucket postings: what is not probed is not read.

Vectors lie once, in blocks of neighbouring hyperplane cells, each block a folder. Beside them
every (table, bucket) is a folder with the rows it holds and their blocks. A query probes in
each table its own bucket and then those across the planes it lies nearest to, so fewer tables
do. A search reads the folders of the probed buckets, then the blocks in which they have rows,
and scores the candidates alone. How much that is depends on the probes, see `share_read`.

A bucket may hold most of the rows: it is many files, and its rows are only a filter on the
blocks; queries and candidates meet in blocks of bounded size as in any other search.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.functions.vectors import SCORE_DIGITS
from vecloom.operators import approx
from vecloom.operators.search import packed
from vecloom.session import settled

# Rows of a block: 16,384.
BLOCK_BITS = 14
# All buckets of a table are put in order for each query.
MAX_BITS = 12
# Costs held at once: 4 M doubles are 32 MB.
COSTS_AT_ONCE = 4_000_000


def probe_order(sides: np.ndarray, probes: int) -> np.ndarray:
    """Which bits to flip, as numbers, shape (rows, tables, probes): the nearest buckets first.

    sides: (rows, tables, bits) distances to the planes, with sign. A bucket is as far as the
    planes between, their squares added up; ties go to the lower number."""
    bits = sides.shape[2]
    masks = (np.arange(1 << bits)[:, None] >> np.arange(bits)) & 1
    cost = np.round((sides * sides) @ masks.T.astype(np.float64), SCORE_DIGITS)
    return np.argsort(cost, axis=2, kind="stable")[:, :, :probes]


def probed_cells(df: DataFrame, dim: int, tables: int, bits: int, probes: int, column: str = "cells") -> DataFrame:
    """The ``probes`` nearest cells of every table, as one array; numbers as in
    :func:`approx.hyperplane_cells`."""
    if bits > MAX_BITS:
        raise ValueError(f"bits must be at most {MAX_BITS}, got {bits}")
    if not 1 <= probes <= 1 << bits:
        raise ValueError(f"probes must be between 1 and {1 << bits}, got {probes}")
    planes = approx.plane_signs(dim, tables, bits).reshape(tables * bits, dim)
    weights = 1 << np.arange(bits)
    step = max(1, COSTS_AT_ONCE // (tables << bits))

    def near(matrix: np.ndarray) -> np.ndarray:
        sides = (matrix @ planes.T).reshape(len(matrix), tables, bits)
        own = ((np.round(sides, SCORE_DIGITS) >= 0) * weights).sum(axis=2)
        cells = (own[:, :, None] ^ probe_order(sides, probes)) + (np.arange(tables) << bits)[:, None]
        return cells.reshape(len(matrix), -1)

    def assign(matrix: np.ndarray) -> np.ndarray:
        return np.concatenate([near(matrix[at : at + step]) for at in range(0, len(matrix), step)])

    return approx._add_cells(df, assign, column)


def write_postings(corpus: DataFrame, path: str, dim: int, tables: int, bits: int) -> None:
    """The blocks, the postings and the settings that made them."""
    spark = corpus.sparkSession
    settings = spark.createDataFrame([(dim, tables, bits)], "dim int, tables int, bits int")
    settings.write.mode("overwrite").parquet(f"{path}/settings")
    celled = approx.hyperplane_cells(packed(corpus), dim, tables, bits)
    ordered = celled.repartitionByRange("cells", "id").sortWithinPartitions("cells", "id")
    numbered = ordered.withColumn("row", F.monotonically_increasing_id())
    blocks = numbered.withColumn("block", F.shiftright("row", BLOCK_BITS))
    blocks.write.mode("overwrite").partitionBy("block").parquet(f"{path}/vectors")
    # From what was written: the rows have their numbers for good.
    cell = spark.read.parquet(f"{path}/vectors").select("block", "row", F.explode("cells").alias("cell"))
    postings = cell.select(
        "block",
        "row",
        F.shiftright("cell", bits).alias("table"),
        F.col("cell").bitwiseAND((1 << bits) - 1).alias("bucket"),
    )
    spread_out = postings.hint("rebalance", "table", "bucket")
    spread_out.write.mode("overwrite").partitionBy("table", "bucket").parquet(f"{path}/postings")


def candidates(asked: DataFrame, path: str, bits: int) -> DataFrame:
    """(block, row) of every vector in a cell that some query probes, as a written table."""
    spark = asked.sparkSession
    # As many rows as there are buckets.
    cells = [r.cell for r in asked.select(F.explode("cells").alias("cell")).distinct().collect()]
    by_table: dict[int, list[int]] = {}
    for cell in sorted(cells):
        by_table.setdefault(cell >> bits, []).append(cell & (1 << bits) - 1)
    probed = [(F.col("table") == t) & F.col("bucket").isin(b) for t, b in by_table.items()]
    postings = spark.read.parquet(f"{path}/postings").where(reduce(or_, probed, F.lit(False)))
    return settled(postings.select("block", "row").distinct(), "candidates")


def candidate_vectors(found: DataFrame, path: str) -> DataFrame:
    """The vectors of the candidates; blocks without one are not read."""
    # One row for each block.
    blocks = [r.block for r in found.select("block").distinct().collect()]
    vectors = found.sparkSession.read.parquet(f"{path}/vectors").where(F.col("block").isin(blocks))
    return vectors.join(found, ["block", "row"], "left_semi").drop("block", "row")


def search_postings(queries: DataFrame, path: str, k: int, probes: int, **options: object) -> DataFrame:
    """Top-k among the candidates of the ``probes`` nearest buckets of each table."""
    made = queries.sparkSession.read.parquet(f"{path}/settings").first()
    asked = probed_cells(queries, made.dim, made.tables, made.bits, min(probes, 1 << made.bits))
    corpus = candidate_vectors(candidates(asked, path, made.bits), path)
    return approx.top_k_in_cells(asked, corpus, k, num_cells=made.tables << made.bits, **options)


def share_read(queries: DataFrame, path: str, probes: int) -> DataFrame:
    """(probes, n_candidates, n_rows, n_blocks_read, n_blocks): what a search for these queries
    scores and reads."""
    spark = queries.sparkSession
    made = spark.read.parquet(f"{path}/settings").first()
    asked = probed_cells(queries, made.dim, made.tables, made.bits, min(probes, 1 << made.bits))
    read = candidates(asked, path, made.bits).agg(
        F.count(F.lit(1)).alias("n_candidates"), F.countDistinct("block").alias("n_blocks_read")
    )
    stored = spark.read.parquet(f"{path}/vectors")
    whole = stored.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("block").alias("n_blocks")).first()
    return read.select(
        F.lit(probes).alias("probes"),
        "n_candidates",
        F.lit(whole.n_rows).cast("bigint").alias("n_rows"),
        "n_blocks_read",
        F.lit(whole.n_blocks).cast("bigint").alias("n_blocks"),
    )
