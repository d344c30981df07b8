"""Comparing within buckets of any size, in tasks of bounded size.

A bucket of n rows is cut into ceil(n / block) blocks by a hash of the row. Every pair of
its blocks is one group of at most two blocks, so that each two rows of a bucket meet in
one group at least. A bucket that fits a block is one group; a row alone in its bucket has
nothing to meet and stays out. Groups are dealt by their key and come sorted to a task,
which reads them one after another in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GROUP = ["bucket", "left", "right"]


def block_pairs(rows: DataFrame, block: int, payload: list[str], order: str) -> DataFrame:
    """Rows (bucket, payload) copied to the groups they belong to, dealt and sorted."""
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    mine = rows.join(sizes, "bucket").select(
        "bucket", *payload, blocks.alias("blocks"), F.pmod(F.xxhash64(order), blocks).cast("int").alias("mine")
    )
    met = mine.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    grouped = met.select(
        "bucket", F.least("mine", "other").alias("left"), F.greatest("mine", "other").alias("right"), "mine", *payload
    )
    return grouped.repartition(*GROUP).sortWithinPartitions(*GROUP, order)


def whole_groups(batches: Iterable[pa.RecordBatch], rows: int = 1 << 15) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups with the start of each group, and the end of the last."""
    kept: list[pa.Table] = []
    count = 0
    for batch in batches:
        kept.append(pa.Table.from_batches([batch]))
        count += batch.num_rows
        if count < rows:
            continue
        joined = pa.concat_tables(kept).combine_chunks()
        starts = _starts(joined)
        kept, count = [joined.slice(starts[-1])], joined.num_rows - int(starts[-1])
        if len(starts) > 1:
            yield joined.slice(0, starts[-1]), starts
    if count:
        joined = pa.concat_tables(kept).combine_chunks()
        yield joined, np.append(_starts(joined), joined.num_rows)


def _starts(joined: pa.Table) -> np.ndarray:
    change = np.zeros(joined.num_rows, bool)
    change[0] = True
    for name in GROUP:
        column = joined.column(name).to_numpy()
        change[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(change)


class Forest:
    """The links of a task reduced to a spanning forest."""

    def __init__(self, n: int):
        self.up = np.arange(n)
        self.kept: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def link(self, left: np.ndarray, right: np.ndarray) -> None:
        differ = self.up[left] != self.up[right]
        for i, j in zip(left[differ].tolist(), right[differ].tolist(), strict=True):
            a, b = self.root(i), self.root(j)
            if a != b:
                self.up[max(a, b)] = min(a, b)
                self.kept.append((i, j))
        while len(left):
            flat = self.up[self.up]
            if (flat == self.up).all():
                break
            self.up = flat


def per_groups(work: Callable[[pa.Table, np.ndarray], pa.RecordBatch], rows: int = 1 << 15):
    """A mapInArrow function that hands whole groups to ``work``, of about so many rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for joined, starts in whole_groups(batches, rows):
            yield work(joined, starts)

    return run
