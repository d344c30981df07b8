"""Operator 7: near-duplicate embeddings by random hyperplanes.

Each table hashes a vector to the signs of its products with random hyperplanes; vectors at
the threshold agree on one sign with probability 1 - angle / pi. The number of signs
follows the number of vectors, so that a bucket of unrelated ones stays near BUCKET_ROWS;
the number of tables then follows from the share of pairs at the threshold that must meet
in some table (RECALL). Rows that meet are compared exactly, in double precision, and a
pair is counted only in the first table where it meets. Buckets of any size are cut into
blocks (blocks.py). A task gives a sum per vector and a spanning forest, never all pairs.

Equal vectors are one class from the start and link with each other. Vectors that are null,
zero or hold null or non-finite numbers link with nothing and are their own component.
Vectors of different lengths are not compared. Repeated rows (also of one id) are vectors
of their own. Null ids never name a component of others. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.llm.blocks import Forest, block_pairs, per_groups
from vecloom.llm.components import connected_components
from vecloom.llm.vectors import by_dimension, packed
from vecloom.session import settled

BUCKET_ROWS = 256
BLOCK_ROWS = 1024
RECALL = 0.99


def tables_for(vectors: int, threshold: float, recall: float = RECALL) -> tuple[int, int]:
    """(signs, tables) for so many vectors."""
    signs = min(40, max(6, math.ceil(math.log2(max(2, vectors) / BUCKET_ROWS))))
    meet = (1 - math.acos(threshold) / math.pi) ** signs
    return signs, math.ceil(math.log(1 - recall) / math.log(1 - meet))


def signatures(raws: list[bytes], signs: int, tables: int, seed: int) -> np.ndarray:
    """One whole number per vector and table."""
    result = np.zeros((len(raws), tables), np.int64)
    powers = np.int64(1) << np.arange(signs, dtype=np.int64)
    for rows, matrix in by_dimension(raws):
        planes = np.random.default_rng([seed, matrix.shape[1]]).standard_normal((matrix.shape[1], tables * signs))
        for at in range(0, len(rows), 2048):
            some = rows[at : at + 2048]
            bits = (matrix[at : at + 2048] @ planes > 0).reshape(len(some), tables, signs)
            result[some] = bits @ powers
    return result


def near_duplicates(
    df: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    threshold: float = 0.9,
    recall: float = RECALL,
    block: int = BLOCK_ROWS,
    seed: int = 7,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of df."""
    rows = settled(df.select(F.col(vec_id).alias("vec_id"), packed(F.col(embedding)).alias("packed")), "vectors")
    usable = F.col("packed").isNotNull() & F.expr("length(replace(hex(substr(packed, 2)), '0', '')) > 0")
    classes = (
        rows.where(usable)
        .groupBy("packed")
        .agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    classes = settled(classes, "classes")
    signs, tables = tables_for(classes.count(), threshold, recall)

    @F.arrow_udf("binary")
    def hashed(raws: pa.Array) -> pa.Array:
        found = signatures(raws.to_pylist(), signs, tables, seed)
        return pa.array([row.tobytes() for row in found], pa.binary())

    @F.arrow_udf("array<bigint>")
    def buckets(hashes: pa.Array) -> pa.Array:
        found = [np.frombuffer(h, np.int64) | np.arange(tables) << 40 for h in hashes.to_pylist()]
        return pa.array(found, pa.list_(pa.int64()))

    signed = settled(classes.withColumn("signs", hashed("packed")).withColumn("buckets", buckets("signs")), "signs")
    hashed_rows = signed.select(F.explode("buckets").alias("bucket"), "node", "copies", "packed", "signs")

    def compared(joined: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        node, copies, mine, left, right = (
            joined.column(c).to_numpy() for c in ("node", "copies", "mine", "left", "right")
        )
        table = joined.column("bucket").to_numpy() >> 40
        raws, hashes = joined.column("packed").to_pylist(), joined.column("signs").to_pylist()
        counts = np.zeros(len(node), np.int64)
        forest = Forest(len(node))
        for start, end in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            for rows_, matrix in by_dimension(raws[start:end]):
                at = rows_ + start
                norms = np.sqrt((matrix * matrix).sum(1))
                for i in range(0, len(at), 512):
                    close = matrix[i : i + 512] @ matrix.T / np.outer(norms[i : i + 512], norms) >= threshold
                    a, b = np.nonzero(close)
                    a = a + i
                    keep = a < b
                    if left[start] != right[start]:
                        keep &= mine[at[a]] != mine[at[b]]
                    a, b = at[a[keep]], at[b[keep]]
                    t = int(table[start])
                    if t and len(a):
                        some = np.unique(np.r_[a, b])
                        earlier = np.stack([np.frombuffer(hashes[x], np.int64, t) for x in some])
                        met = (earlier[np.searchsorted(some, a)] == earlier[np.searchsorted(some, b)]).any(1)
                        a, b = a[~met], b[~met]
                    np.add.at(counts, a, copies[b])
                    np.add.at(counts, b, copies[a])
                    forest.link(a, b)
        linked = np.flatnonzero(counts)
        kept = np.array(forest.kept, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.r_[node[linked], node[kept[:, 0]]], pa.int64()),
                pa.array([None] * len(linked) + node[kept[:, 1]].tolist(), pa.int64()),
                pa.array(np.r_[counts[linked], np.zeros(len(kept), np.int64)], pa.int64()),
            ],
            ["a", "b", "n"],
        )

    met = block_pairs(hashed_rows, block, ["node", "copies", "packed", "signs"], "node")
    found = settled(met.mapInArrow(per_groups(compared), "a bigint, b bigint, n bigint"), "links")
    parts = connected_components(found.where("b IS NOT NULL"), "a", "b")
    links = found.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    named = (
        classes.join(links, "node", "left")
        .join(parts, "node", "left")
        .select(
            "packed",
            "first",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    named = settled(named, "components")
    lowest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = named.join(lowest, "component").select("packed", "n_links", "component_id")
    return rows.join(named, "packed", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("component_id", "vec_id")).alias("kept"),
    )
