"""Exact top-k search: every query against every stored vector.

Two plans give the same rows.

* *Scan*: the queries come in blocks, sized so that a task holds a block with its best ``k``
  rows per query; each task of a corpus scan holds one block. The corpus is read once per
  block and never shuffled; only ``tasks x queries x k`` rows are. Several blocks go in
  rounds of MAX_BLOCKS: queries and packed corpus are written once before, and a round's
  hits after, so what the driver and a task hold does not grow with the queries.
* *Grid* (:mod:`vecloom.operators.cells`), where ``limit_bytes`` is 0: both sides are cut
  into blocks by a hash of their id, and each pair of blocks is one bounded task.

Neither plan materialises query-vector pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.operators import cells
from vecloom.operators.kernel import (
    BestRows,
    hits_tables,
    pack,
    parts_by_cell,
    queries_by_cell,
    to_matrix,
)
from vecloom.session import TASKS_PER_CORE, settled, spread

METRICS = ("ip", "cosine")
# Largest query block a task may hold, in bytes: the queries as float64 and their best rows.
BROADCAST_BYTES = 64 * 1024 * 1024
# What a kept row takes, its id and carried columns included.
KEPT_BYTES = 100
# Blocks of one round, which the driver holds together.
MAX_BLOCKS = 16
# Vectors that a task scores at a time, and their bytes where fewer of them have as many.
BLOCK_ROWS = 1 << 15
BLOCK_BYTES = 16 * 1024 * 1024
# Rows that a task keeps for several shards before it hands them over.
MAX_KEPT = 1 << 20
# Splits of the corpus that one task of several blocks reads at most: 512 MB in all.
SPLITS_PER_TASK = 4
# A query's partial results are merged in so many parts first.
MERGE_PARTS = 32
MAX_SERVICE_K = 50


@dataclass
class QueryBlock:
    """A query set small enough for every task to hold."""

    ids: pa.Array
    matrix: np.ndarray
    probes: list[np.ndarray] | None = None
    wanted: np.ndarray | None = None


def check_k(k: int, most: int | None = None) -> int:
    if k < 1 or (most is not None and k > most):
        raise ValueError(f"k must be >= 1{f' and <= {most}' if most else ''}, got {k}")
    return k


def check_metric(metric: str) -> str:
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}, got {metric!r}")
    return metric


def query_size(queries: DataFrame) -> tuple[int, int]:
    """Number and dimension of the query vectors."""
    is_packed = isinstance(queries.schema["embedding"].dataType, T.BinaryType)
    width = F.octet_length("embedding") / 4 if is_packed else F.size("embedding")
    rows, dim = queries.agg(F.count(F.lit(1)), F.max(width).cast("int")).first()
    return rows, dim or 0


def packed(vectors: DataFrame) -> DataFrame:
    """The same rows with ``embedding`` as float32 bytes. Spark copies such a value whole
    on its way to Python, where an array is copied element by element; every search
    operator reads both forms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = batch.schema.get_field_index("embedding")
                columns = [*batch.columns[:at], pack(batch.column(at)), *batch.columns[at + 1 :]]
                yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    fields = [
        T.StructField(f.name, T.BinaryType() if f.name == "embedding" else f.dataType)
        for f in vectors.schema
    ]
    return vectors.mapInArrow(run, T.StructType(fields))


def block_count(size: tuple[int, int], k: int, limit_bytes: int = BROADCAST_BYTES) -> int:
    """In how many blocks queries of that size are searched for their best ``k``."""
    return max(1, -(-size[0] * (size[1] * 8 + k * KEPT_BYTES) // limit_bytes))


def fits(size: tuple[int, int], k: int, limit_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether every task may hold that many queries and their best ``k``."""
    return limit_bytes > 0 and block_count(size, k, limit_bytes) == 1


def fetch_block(queries: DataFrame, size: tuple[int, int]) -> QueryBlock:
    """The queries as one block. Call it only for a size that :func:`fits`."""
    columns = ["query_id", "embedding"] + [c for c in ("probes", "wanted") if c in queries.columns]
    table = queries.select(*columns).toArrow()
    probes = wanted = None
    if "probes" in columns:
        probes = [np.asarray(p, dtype=np.int64) for p in table.column("probes").to_pylist()]
    if "wanted" in columns:
        wanted = table.column("wanted").to_numpy()
    matrix = to_matrix(table.column("embedding"), size[1])
    return QueryBlock(table.column("query_id").combine_chunks(), matrix, probes, wanted)


def hit_schema(queries: DataFrame, corpus: DataFrame, carry: tuple[str, ...]) -> T.StructType:
    fields = [corpus.schema[name] for name in carry]
    return T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("id", corpus.schema["id"].dataType),
            *[T.StructField(f.name, f.dataType) for f in fields],
            T.StructField("score", T.DoubleType()),
        ]
    )


def scan_best(
    corpus: DataFrame,
    block: QueryBlock,
    k: int,
    schema: T.StructType,
    *,
    metric: str = "ip",
    carry: tuple[str, ...] = (),
    by: str | None = None,
    cell: str | None = None,
) -> DataFrame:
    """Each task's best ``k`` rows per query (as many of them as the query wants), and per
    value of ``by`` if given.

    With ``cell`` (an ARRAY<INT> column), a row meets only the queries whose probes
    name one of its cells.
    """
    context = corpus.sparkSession.sparkContext
    shared = context.broadcast((block.ids, block.matrix, block.probes, block.wanted))
    names = ["id", *carry]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, query_matrix, probes, wanted = shared.value
        if len(query_ids) == 0:
            return
        kept: dict[object, BestRows] = {}
        asking = None if cell is None else queries_by_cell(probes)
        for block_rows in _joined(batches):
            vectors = to_matrix(block_rows.column("embedding"), query_matrix.shape[1])
            rows = block_rows.select(names)
            for value, at in _groups(rows, by):
                if value not in kept:
                    # The prepared queries are shared by the shards a task sees.
                    other = next(iter(kept.values()), None)
                    kept[value] = other.fresh() if other else BestRows(query_matrix, k, metric, wanted)
                best, parts = kept[value], None
                if cell is not None:
                    cells_of = to_matrix(block_rows.column(cell))
                    parts = parts_by_cell(cells_of if at is None else cells_of[at], asking)
                if at is None:
                    best.offer(rows, vectors, parts)
                else:
                    best.offer(rows.take(pa.array(at)), vectors[at], parts)
            if len(kept) > 1 and sum(best.count() for best in kept.values()) > MAX_KEPT:
                for best in kept.values():
                    for table in hits_tables(best, query_ids, rows):
                        yield from table.to_batches()
                    best.handed_over()
        for best in kept.values():
            for table in hits_tables(best, query_ids, rows):
                yield from table.to_batches()

    needed = list(dict.fromkeys([*names, "embedding", *([cell] if cell else [])]))
    return corpus.select(*needed).mapInArrow(run, schema)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The batches as tables of BLOCK_ROWS rows, or of BLOCK_BYTES, or a batch more."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            waiting.append(batch)
        if sum(b.num_rows for b in waiting) >= BLOCK_ROWS or sum(b.nbytes for b in waiting) >= BLOCK_BYTES:
            block, waiting = pa.Table.from_batches(waiting).combine_chunks(), []
            yield block
    if waiting:
        yield pa.Table.from_batches(waiting).combine_chunks()


def search_in_blocks(
    queries: DataFrame,
    corpus: DataFrame,
    size: tuple[int, int],
    k: int,
    limit_bytes: int,
    find: Callable[[QueryBlock, DataFrame], DataFrame],
    finish: Callable[[DataFrame, bool], DataFrame],
) -> DataFrame:
    """``finish`` of what ``find`` returns for the queries, a block or a round of blocks at a
    time. All of a query's hits are in one round. ``finish`` is told whether many tasks may
    have scanned for a query."""
    blocks = block_count(size, k, limit_bytes)
    if blocks == 1:
        return finish(find(fetch_block(queries, size), corpus), True)
    # A tenth more than needed, so that an uneven hash does not pass the limit.
    blocks += -(-blocks // 10)
    cores = queries.sparkSession.sparkContext.defaultParallelism
    dealt = queries.withColumn("__block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    dealt = settled(dealt.repartition("__block"), "queries", "__block")
    if not isinstance(corpus.schema["embedding"].dataType, T.BinaryType):
        corpus = packed(corpus)
    corpus = settled(spread(corpus, "id"), "corpus")
    # Fewer tasks than splits where the blocks occupy the cores: fewer partial results.
    chosen = [range(blocks)[n : n + MAX_BLOCKS] for n in range(0, blocks, MAX_BLOCKS)]
    splits = corpus.rdd.getNumPartitions()
    tasks = max(-(-TASKS_PER_CORE * cores // len(chosen[-1])), -(-splits // SPLITS_PER_TASK))
    corpus = corpus.coalesce(tasks)
    rounds = []
    for numbers in chosen:
        found = [find(fetch_block(dealt.where(F.col("__block") == n), size), corpus) for n in numbers]
        rounds.append(settled(finish(reduce(DataFrame.unionAll, found), tasks > MERGE_PARTS), "found"))
    return reduce(DataFrame.unionAll, rounds)


def _groups(rows: pa.Table, by: str | None) -> Iterator[tuple[object, np.ndarray | None]]:
    """The positions of each value of ``by``; one group of everything without it."""
    if by is None:
        yield None, None
        return
    values = rows.column(by).to_numpy()
    for value in np.unique(values):
        yield value, np.flatnonzero(values == value)


def merge_best(
    hits: DataFrame, k: int, *, by: str | None = None, repeated: bool = False, in_parts: bool = True
) -> DataFrame:
    """Partial results to the final ``rank`` 1..k per query: score down, then id up.

    Spark cuts each map task's rows to ``k`` before the exchange (WindowGroupLimit).
    The scan tasks' rows of a query are merged in parts by a hash of the id first (with
    ``by`` per shard as well), so that no task gets those of all scan tasks.
    Where few tasks scan for a query, ``in_parts`` can be false.
    ``repeated`` hits, found through several cells, count once.
    """
    order = (F.col("score").desc(), F.col("id").asc())
    position = F.dense_rank() if repeated else F.row_number()
    if in_parts:
        hits = hits.withColumn("__part", F.pmod(F.xxhash64("id"), F.lit(MERGE_PARTS)))
        part = Window.partitionBy("query_id", *([by] if by else []), "__part").orderBy(*order)
        hits = hits.withColumn("rank", position.over(part)).where(F.col("rank") <= k).drop("__part")
    whole = Window.partitionBy("query_id").orderBy(*order)
    ranked = hits.withColumn("rank", position.over(whole)).where(F.col("rank") <= k)
    return ranked.dropDuplicates(["query_id", "rank"]) if repeated else ranked


def exact_top_k(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    *,
    metric: str = "ip",
    carry: tuple[str, ...] = (),
    by: str | None = None,
    exclude_self: bool = False,
    size: tuple[int, int] | None = None,
    limit_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(query_id, rank, id, carry.., score)`` with the best ``k`` rows per query.

    ``queries`` has ``query_id`` (unique, not null: callers whose ids may repeat number
    them, as :func:`vecloom.plans.requests.text_search` does) and ``embedding``; ``corpus`` has ``id``,
    ``embedding`` (arrays or packed) and the carried columns. Where queries have ``wanted``
    (1 to ``k``), only that many of a query's rows are sought: those of a higher rank may be missing
    or others, so the caller cuts. ``exclude_self`` leaves out the row whose id is the query's own. ``by`` names the shard column for per-shard search and
    merge, which gives the same rows. ``size`` is the queries' (rows, dimension) where
    the caller knows it; otherwise it is measured before anything is fetched.
    """
    check_k(k)
    check_metric(metric)
    if by is not None and by not in carry:
        carry = (*carry, by)
    wanted = k + 1 if exclude_self else k
    schema = hit_schema(queries, corpus, carry)
    size = size or query_size(queries)

    def finish(hits: DataFrame, in_parts: bool = True) -> DataFrame:
        if exclude_self:
            # The own row takes at most one of the k + 1 places.
            hits = hits.where(F.col("id") != F.col("query_id").cast(schema["id"].dataType))
        return merge_best(hits, k, by=by, in_parts=in_parts).select("query_id", "rank", "id", *carry, "score")

    if limit_bytes:
        def find(block: QueryBlock, stored: DataFrame) -> DataFrame:
            return scan_best(stored, block, wanted, schema, metric=metric, carry=carry, by=by)

        needed = list(dict.fromkeys(["id", *carry, "embedding"]))
        asked = queries.select("query_id", "embedding")
        if "wanted" in queries.columns:
            asked = queries.select("query_id", "embedding", F.col("wanted") + int(exclude_self))
            asked = asked.toDF("query_id", "embedding", "wanted")
        return search_in_blocks(
            asked, corpus.select(*needed), size, wanted, limit_bytes, find, finish
        )
    return finish(
        cells.best_in_cells(
            queries.withColumn("cell", F.lit(0)),
            corpus.withColumn("cell", F.lit(0)),
            wanted,
            schema,
            metric=metric,
            carry=carry,
            dim=size[1],
        )
    )
