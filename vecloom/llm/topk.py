"""Operator 4: exact top-k by a three-phase uniform threshold.

A score is a sum over PARTS slices of dimensions. The slices are stored apart, each as a list
of its own, and the lists are sorted by the length of the slice in every task: no entry from
some place on can have more than that length times the query's.

1. Every task takes its best k entries of each list, as far down as the lengths allow more.
   An entry has its whole vector with it, so the candidates' whole scores are resolved where
   they are found; the k-th best of all tasks' candidates is a cutoff that k rows surely reach.
2. The cutoffs of a query block are broadcast. A row that reaches a cutoff has an entry of at
   least cutoff / PARTS in some list, so each list is read down to where its lengths fall
   below that, and only entries from there on are collected, if what the other slices can add
   may still reach the cutoff.
3. The missing part of a sufficient entry's score is resolved where it was found, exactly; rows
   that reach the cutoff are merged.

Queries come in blocks of about BLOCK_QUERIES, whatever their number; a block is what is
broadcast (its vectors and cutoffs). No list is shuffled for it, only candidates are. Per query
a task gives k rows of each list in phase 1; whole scores are merged in two levels, so that no
task gets the rows of all scan tasks for a query. How much is not scored depends on the data:
slices of much the same length are all scored, once in each of the first two phases.

Components are floor(scale * x). Scores are exact: beyond 2^53 whole-number arithmetic is
used, and scores outside a long are held at its limits. Vectors that are null or hold null
or non-finite components take no part, nor do rows with a null id. Rows are told apart by
id: a query's own rows are those of its id, equal query rows are asked once, and repeated
candidate rows count each. Vectors of different lengths are not compared. Ties go to the
smaller id. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vecloom.llm.vectors import by_dimension, packed
from vecloom.session import run_dir, settled

PARTS = 2
BLOCK_QUERIES = 2048
MERGE_BUCKETS = 32
ROWS_AT_ONCE = 1024
# Of either side of the pairs whose products are taken at once: 2 MB, which fits the cache.
VALUES_AT_ONCE = 1 << 18
LONG = 2**63 - 1
REACHED = "query_id bigint, row bigint, vec_id bigint, score bigint"
# A query is its place in the block here.
NAMES = ["query", "row", "entry", "query_id", "score"]
FOUND = "query bigint, row bigint, entry double, query_id bigint, score bigint"
ENTRY = "part int, dims int, length double, rest double, row bigint, vec_id bigint, whole binary"


def slices(dims: int) -> list[tuple[int, int]]:
    edges = np.linspace(0, dims, PARTS + 1).astype(int).tolist()
    return list(zip(edges, edges[1:], strict=False))


def lengths(matrix: np.ndarray) -> np.ndarray:
    """The length of each row, no less than it is; very large numbers may give infinity."""
    with np.errstate(over="ignore"):
        return np.nextafter(np.sqrt((matrix * matrix).sum(1)) * (1 + 2.0**-40), np.inf)


def _entries(scale: float) -> Callable:
    """A mapInArrow function: (row, vec_id, packed) as the entries of all lists. rest: the
    length of what is outside the slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, ids = (batch.column(i).to_numpy() for i in (0, 1))
            for some, matrix in by_dimension(batch.column(2).to_pylist()):
                matrix = np.floor(scale * matrix)
                for part, (low, high) in enumerate(slices(matrix.shape[1])):
                    own = matrix[:, low:high]
                    rest = np.delete(matrix, np.s_[low:high], axis=1)
                    n = len(some)
                    arrays = [
                        pa.array(np.full(n, part, np.int32)),
                        pa.array(np.full(n, matrix.shape[1], np.int32)),
                        pa.array(lengths(own)),
                        pa.array(lengths(rest)),
                        pa.array(row[some]),
                        pa.array(ids[some]),
                        pa.array([v.tobytes() for v in matrix], pa.binary()),
                    ]
                    names = ["part", "dims", "length", "rest", "row", "vec_id", "whole"]
                    yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def _longs(scores: np.ndarray) -> np.ndarray:
    if scores.dtype == object:
        return np.array([min(LONG, max(-LONG, int(s))) for s in scores], np.int64)
    return scores.astype(np.int64)


class Block:
    """The queries of a block by their dimension: places, vectors, lengths of and outside a slice."""

    def __init__(self, block: list[tuple[int, bytes]], scale: float):
        self.ids = np.array([i for i, _ in block], np.int64)
        self.groups = {m.shape[1]: (at, np.floor(scale * m)) for at, m in by_dimension([r for _, r in block])}

    def slice(self, dims: int, part: int) -> tuple[np.ndarray, ...] | None:
        if dims not in self.groups:
            return None
        at, matrix = self.groups[dims]
        low, high = slices(dims)[part]
        own = matrix[:, low:high]
        return at, own, lengths(own), lengths(np.delete(matrix, np.s_[low:high], axis=1))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(part, dims, length, rest, row, id, vectors) of some neighbours in one list."""
    for batch in batches:
        part, dims, length, rest, row, ids = (batch.column(i).to_numpy() for i in range(6))
        change = np.flatnonzero(np.diff(part) | np.diff(dims)) + 1
        for begin, end in zip([0, *change.tolist()], [*change.tolist(), len(part)], strict=True):
            for at in range(begin, end, ROWS_AT_ONCE):
                s = slice(at, min(end, at + ROWS_AT_ONCE))
                if s.start < s.stop:
                    raw = b"".join(batch.column(6).slice(s.start, s.stop - s.start).to_pylist())
                    matrix = np.frombuffer(raw, np.float64).reshape(s.stop - s.start, -1)
                    yield int(part[at]), int(dims[at]), length[s], rest[s], row[s], ids[s], matrix


def _partial(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Partial scores, no less than they are: whole numbers below 2^53 exactly."""
    with np.errstate(over="ignore", invalid="ignore"):
        found = queries @ rows.T
        ours, theirs = lengths(queries), lengths(rows)
        if ours.max(initial=0) * theirs.max(initial=0) < 2.0**53:
            return found
        bound = ours[:, None] * theirs[None, :]
        found = np.where(bound < 2.0**53, found, found + bound * 2.0**-40)
    return np.where(np.isnan(found), np.inf, found)


def _own(asked: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of the pairs that have the same id."""
    some = np.flatnonzero(np.isin(ids, asked))
    query, place = np.nonzero(asked[:, None] == ids[some][None, :])
    return query, some[place]


def _merge(best: tuple[np.ndarray, ...], live: np.ndarray, found: np.ndarray, row: np.ndarray) -> tuple:
    """Put the entries ``found`` by the ``live`` queries among the best k they hold: the larger
    first, of equal ones those that were held, then in the order of the list. Only what is
    larger than a query's k-th best is sorted. Returns the query, its place and the row of each
    that came in, for its whole score."""
    entry, rows, score = best
    k = entry.shape[1]
    enter = found > entry[live, -1:]
    many = np.flatnonzero(np.count_nonzero(enter, axis=1) > k)
    if len(many):
        least = np.partition(found[many], -k, axis=1)[:, -k]
        enter[many] &= found[many] >= least[:, None]
    query, new = np.nonzero(enter)
    changed = np.unique(query)
    at = live[changed]
    whose = np.concatenate([np.repeat(changed, k), query])
    both = np.concatenate([entry[at].ravel(), found[query, new]])
    names = np.concatenate([rows[at].ravel(), row[new]])
    whole = np.concatenate([score[at].ravel(), np.zeros_like(new)])
    came = np.concatenate([np.full(at.size * k, -1), new])
    order = np.lexsort((-both, whose))
    first = np.searchsorted(whose[order], changed)
    order = order[first[:, None] + np.arange(k)]
    entry[at], rows[at], score[at], came = both[order], names[order], whole[order], came[order]
    query, place = np.nonzero(came >= 0)
    return at[query], place, came[query, place]


def local_lists(block: Block, k: int, scored: list | None = None) -> Callable:
    """Phase 1, a mapInArrow function: the best k entries a task has of each list, with the whole
    scores of their rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict = {}
        for part, dims, length, _, row, ids, matrix in _chunks(batches):
            held = block.slice(dims, part)
            if held is None:
                continue
            at, queries, reach, _ = held
            if (part, dims) not in best:
                size = (len(at), k)
                best[part, dims] = np.full(size, -np.inf), np.full(size, -1), np.zeros(size, np.int64)
            entry, _, score = best[part, dims]
            with np.errstate(over="ignore", invalid="ignore"):
                live = np.flatnonzero(~(reach * length.max() <= entry[:, -1]))
            if not len(live):
                continue
            if scored is not None:
                scored.append(len(live) * len(row))
            low, high = slices(dims)[part]
            found = _partial(queries[live], matrix[:, low:high])
            found[_own(block.ids[at[live]], ids)] = -np.inf
            query, place, new = _merge(best[part, dims], live, found, row)
            score[query, place] = whole_scores(block, dims, query, matrix, new)
        for (_, dims), (entry, rows, score) in best.items():
            q, place = np.nonzero(entry > -np.inf)
            query = block.groups[dims][0][q]
            arrays = [query, rows[q, place], entry[q, place], block.ids[query], score[q, place]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], NAMES)

    return run


def sufficient(block: Block, cutoffs: np.ndarray, scored: list | None = None) -> Callable:
    """Phases 2 and 3, a mapInArrow function: rows with an entry that can belong to a score above
    the cutoff, and with such a score. A row may come from several lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, dims, length, rest, row, ids, matrix in _chunks(batches):
            held = block.slice(dims, part)
            if held is None:
                continue
            at, queries, reach, beyond = held
            least = cutoffs[at] / PARTS
            with np.errstate(over="ignore", invalid="ignore"):
                live = np.flatnonzero(~(reach * length.max() < least))
            if not len(live):
                continue
            if scored is not None:
                scored.append(len(live) * len(row))
            low, high = slices(dims)[part]
            found = _partial(queries[live], matrix[:, low:high])
            for q, r in _pieces(dims, *np.nonzero(found >= least[live][:, None])):
                cutoff = cutoffs[at[live[q]]]
                with np.errstate(over="ignore", invalid="ignore"):
                    short = found[q, r] + beyond[live[q]] * rest[r] < cutoff
                own = block.ids[at[live[q]]] == ids[r]
                q, r, cutoff = (x[~short & ~own] for x in (q, r, cutoff))
                score = _products(block.groups[dims][1][live[q]], matrix[r])
                reached = (score >= cutoff).astype(bool)
                q, r = q[reached], r[reached]
                if not len(q):
                    continue
                arrays = [block.ids[at[live[q]]], row[r], ids[r], _longs(score[reached])]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["query_id", "row", "vec_id", "score"])

    return run


def _products(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The inner product of each row with its partner."""
    bound = float(np.abs(one).max(initial=0)) * float(np.abs(other).max(initial=0)) * max(1, one.shape[1])
    if bound >= 2.0**53:
        whole = np.vectorize(int, otypes=[object])
        return (whole(one) * whole(other)).sum(1)
    return np.einsum("ij,ij->i", one, other)


def _pieces(dims: int, *pairs: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """The pairs in pieces of at most about VALUES_AT_ONCE components of either side."""
    count = len(pairs[0]) * dims // VALUES_AT_ONCE + 1
    return zip(*(np.array_split(x, count) for x in pairs), strict=True)


def whole_scores(block: Block, dims: int, query: np.ndarray, matrix: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The exact scores of queries, by their places among those of the dimension, and rows of
    the matrix."""
    queries = block.groups[dims][1]
    return np.concatenate([_longs(_products(queries[q], matrix[r])) for q, r in _pieces(dims, query, row)])


def best_k(found: DataFrame, k: int, query: str = "query_id", score: str = "score", row: str = "vec_id") -> DataFrame:
    """The k best rows of each query, ranked, merged in two levels."""
    order = [F.desc(score), row]
    level = Window.partitionBy(query, "bucket").orderBy(*order)
    some = found.withColumn("bucket", F.pmod(F.spark_partition_id(), F.lit(MERGE_BUCKETS)))
    some = some.withColumn("rank", F.row_number().over(level)).where(F.col("rank") <= k).drop("rank", "bucket")
    whole = Window.partitionBy(query).orderBy(*order)
    return some.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)


def top_k(
    df: DataFrame,
    asked: Column,
    k: int = 20,
    scale: float = 64.0,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of df for each row where ``asked``."""
    spark = df.sparkSession
    rows = df.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(vec_id).cast("bigint").alias("vec_id"),
        packed(F.col(embedding)).alias("packed"),
        asked.alias("asked"),
    ).where("vec_id IS NOT NULL AND packed IS NOT NULL")
    rows = settled(rows, "vectors")
    queries = rows.where("asked").select("vec_id", "packed").distinct()
    blocks = -(-queries.count() // block_queries)
    dealt = F.pmod(F.xxhash64("vec_id", "packed"), F.lit(max(1, blocks)))
    queries = settled(queries.withColumn("block", dealt), "queries")
    entries = rows.select("row", "vec_id", "packed").mapInArrow(_entries(scale), ENTRY).sortWithinPartitions("part", "dims", F.desc("length"))
    entries = settled(entries, "lists")
    folder = run_dir(spark, "topk")
    kind = "query_id bigint, rank int, vec_id bigint, score bigint"

    for number in range(blocks):
        # About block_queries rows: the block is what every task holds.
        asked_rows = queries.where(F.col("block") == number).collect()
        block = Block([(r.vec_id, bytes(r.packed)) for r in asked_rows], scale)
        listed = entries.mapInArrow(local_lists(block, k), FOUND)
        # A row may come from each of its lists: so many hold k rows at least.
        listed = best_k(listed.select("query_id", "row", "score"), PARTS * k, row="row").drop("rank")
        listed = best_k(listed.distinct(), k, row="row")
        least = {r.query_id: r.score for r in listed.where(F.col("rank") == k).select("query_id", "score").collect()}
        # float(score) may round up beyond 2^53; stay below it.
        cutoffs = [np.nextafter(float(least[i]), -np.inf) if i in least else -np.inf for i in block.ids.tolist()]
        found = entries.mapInArrow(sufficient(block, np.array(cutoffs)), REACHED)
        found = best_k(found.distinct(), k)
        found.select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(folder)
    if not blocks:
        spark.createDataFrame([], kind).write.parquet(folder)
    return spark.read.schema(kind).parquet(folder)
