"""Scoring one Arrow block of vectors against a block of queries.

Small numpy helpers that run inside tasks. Spark decides which rows meet which
queries; nothing here holds more than one block and the best ``k`` rows per query.
"""

from __future__ import annotations

import copy
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from vecloom.functions.vectors import SCORE_DIGITS

# Scores are computed in tiles: 256 x 16,384 floats are 16 MB.
QUERY_TILE = 256
ROW_TILE = 1 << 14
# The rows of which all scores are looked at first.
FIRST_ROWS = 1 << 12
# Tiles of the blocks after the first, of which only chunks with a high score are looked at:
# 1,024 x 1,024 floats are 4 MB.
LATER_QUERIES = 1 << 10
LATER_ROWS = 1 << 10
# Where a greater share of a tile's chunks has one, all scores are looked at.
CHUNK_SHARE = 1 / 4
# Queries whose kept rows are merged together, so that a merge sorts few rows.
QUERY_GROUP = 2048
# A block's rows are put in leaves of so many rows that lie close together along so many main
# axes; a leaf is scored for the queries whose bound on its scores reaches their floor.
LEAF_ROWS = 160
MAIN_AXES = 8
# Where leaves spare less than this share of the scores, the next blocks do without.
SPARED = 1 / 5
BLOCKS_WITHOUT = 16
# Candidates that are scored exactly at a time.
PAIRS_AT_ONCE = 1 << 18
# A tile's k-th best is bounded from below by the k-th of the maxima of its chunks.
CHUNK_ROWS = 64
# Rows this close below a cut are kept until their scores have been rounded.
_ROUNDING = 2 * 10.0**-SCORE_DIGITS
# Above this the float32 products could overflow, so tiles are computed in float64.
_FLOAT32_SAFE = 1e30

# A part of the work: positions of queries and of rows, None meaning all of them.
Part = tuple[np.ndarray | None, np.ndarray | None]


def to_matrix(column: pa.Array | pa.ChunkedArray, dim: int | None = None) -> np.ndarray:
    """A list or packed column as a matrix. Missing or uneven vectors are errors."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros((0, dim or 0), dtype=np.float32)
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        return _checked(*_unpacked(column), column.null_count, dim)
    flat = column.flatten()
    lengths = np.diff(column.offsets.to_numpy())
    values = flat.to_numpy(zero_copy_only=False)
    return _checked(values, lengths, column.null_count + flat.null_count, dim)


def _checked(
    values: np.ndarray, lengths: np.ndarray, missing: int, dim: int | None
) -> np.ndarray:
    if missing:
        raise ValueError("a vector is null or has a null element")
    width = int(lengths[0]) if dim is None else dim
    if not (lengths == width).all():
        raise ValueError(f"every vector must have {width} dimensions")
    if not np.isfinite(values).all():
        raise ValueError("a vector has a non-finite element")
    return values.reshape(len(lengths), width)


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values of a packed column and the dimension of each row, without a copy."""
    _, offset_buffer, data = column.buffers()
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(offset_buffer, dtype=kind)[column.offset :][: len(column) + 1]
    raw = np.frombuffer(data or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    lengths = np.diff(offsets)
    if (lengths % 4).any():
        raise ValueError("a packed vector is not made of whole floats")
    return raw.view("<f4"), lengths // 4


def pack(column: pa.Array) -> pa.Array:
    """A list column as little-endian float32 bytes, one value per vector."""
    matrix = np.ascontiguousarray(to_matrix(column), dtype="<f4")
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * np.int32(4 * matrix.shape[1])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(matrix)]
    return pa.BinaryArray.from_buffers(pa.binary(), len(matrix), buffers)


def lengths_of(matrix: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", matrix, matrix, dtype=np.float64))


def to_unit(matrix: np.ndarray) -> np.ndarray:
    """Rows at length one, in float64; zero rows stay zero."""
    matrix = matrix.astype(np.float64)
    lengths = lengths_of(matrix)[:, None]
    return np.divide(matrix, lengths, out=np.zeros_like(matrix), where=lengths > 0)


def _first_k(query: np.ndarray, score: np.ndarray, tie: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Positions of the best ``k[query]`` rows of each query: score down, then ``tie`` up."""
    return _cut(np.lexsort((tie, -score, query)), query, k)


def _cut(order: np.ndarray, query: np.ndarray, k: np.ndarray) -> np.ndarray:
    """The first ``k[query]`` of each query of positions that are in order."""
    ordered = query[order]
    starts = np.r_[True, ordered[1:] != ordered[:-1]] if len(order) else np.zeros(0, bool)
    first = np.maximum.accumulate(np.where(starts, np.arange(len(order)), 0))
    return order[np.arange(len(order)) - first < k[ordered]]


def _first_k_by_id(found: pa.Table, k: np.ndarray) -> np.ndarray:
    """Positions of the best ``k[query]`` rows of each query: score down, then id up. Ids are
    put in order only where scores are equal."""
    query, score = found.column("query").to_numpy(), found.column("score").to_numpy()
    order = np.lexsort((-score, query))
    same = (query[order][1:] == query[order][:-1]) & (score[order][1:] == score[order][:-1])
    if not same.any():
        return _cut(order, query, k)
    equal = order[np.r_[False, same] | np.r_[same, False]]
    tie = np.zeros(len(order), dtype=np.int64)
    tie[equal] = _id_order(found.column("id").take(pa.array(equal)))
    return _first_k(query, score, tie, k)


@dataclass
class Leaves:
    """Rows of a block that lie close together: positions by leaf, what bounds the scores of
    each leaf, the positions in no leaf, and the error of the bounds for each query."""

    order: np.ndarray
    bounds: np.ndarray
    rest: np.ndarray
    error: np.ndarray


def _along(matrix: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """The rows along the first MAIN_AXES of ``axes``, and the length of what is left."""
    turned = matrix @ axes
    rest = turned[:, MAIN_AXES:]
    return np.hstack([turned[:, :MAIN_AXES], lengths_of(rest)[:, None].astype(np.float32)])


def _neighbours(points: np.ndarray, size: int) -> np.ndarray:
    """Positions in groups of at least ``size`` and less than twice as many, each group being
    cut in the middle along its widest column. The last few positions may be left out."""
    depth = int(np.log2(len(points) // size))
    order = np.arange(len(points) >> depth << depth)[None]
    for _ in range(depth):
        held = points[order]
        widest = held.std(axis=1).argmax(axis=1)
        column = np.take_along_axis(held, widest[:, None, None], axis=2)[:, :, 0]
        halves = np.argpartition(column, order.shape[1] // 2, axis=1)
        order = np.take_along_axis(order, halves, axis=1).reshape(2 * len(order), -1)
    return order


class BestRows:
    """The best ``k`` rows per query over any number of blocks, or as many of them as
    ``wanted`` (1 to ``k``) says for each query.

    A block is scored in float32 to find the rows that can matter: those within the
    arithmetic's error bound of the query's k-th best. Only these are scored again in
    float64, so the result is that of float64 throughout.

    Beside the queries and one tile it holds ``k`` rows per query; they are kept and merged
    for QUERY_GROUP queries at a time.
    """

    def __init__(
        self, queries: np.ndarray, k: int, metric: str = "ip", wanted: np.ndarray | None = None
    ) -> None:
        self._unit = metric == "cosine"
        self._queries = to_unit(queries) if self._unit else queries
        with np.errstate(over="ignore"):
            self._rough = self._queries.astype(np.float32, copy=False)
        self._lengths = lengths_of(self._queries)
        self.dim = queries.shape[1]
        self._k = k
        self._wanted = np.full(len(queries), k) if wanted is None else wanted
        self._scores: np.ndarray | None = None
        self._axes: np.ndarray | None = None
        self._without = 0
        self._empty()

    def _empty(self) -> None:
        # Every query has as many kept rows as it wants that score no less than its floor.
        self._floor = np.full(len(self._queries), -np.inf)
        groups = -(-len(self._queries) // QUERY_GROUP)
        self._kept: list[pa.Table | None] = [None] * groups
        self._pending: list[list[pa.Table]] = [[] for _ in range(groups)]

    def fresh(self) -> BestRows:
        """An empty one for the same queries, which it shares."""
        other = copy.copy(self)
        other._empty()
        return other

    def offer(
        self, rows: pa.Table, matrix: np.ndarray, parts: Iterable[Part] | None = None
    ) -> None:
        """Score a block. ``rows`` has ``id`` and whatever else the winners carry.
        ``parts`` limits which queries meet which rows; parts may overlap, and name their
        queries in order."""
        if len(matrix) == 0 or len(self._queries) == 0:
            return
        if self._unit:
            matrix = to_unit(matrix)
        if parts is not None:
            self._offer(rows, matrix, parts)
            return
        if self._floor.min() == -np.inf:
            # The first rows set the floors for the others.
            for count in (FIRST_ROWS, ROW_TILE):
                self._offer(rows.slice(0, count), matrix[:count])
                rows, matrix = rows.slice(count), matrix[count:]
        leaves = self._in_order(matrix) if len(matrix) and self._floor.min() > -np.inf else None
        if leaves is not None:
            self._offer(rows, matrix, None, leaves)
            return
        # What a piece finds raises the floors for the next one.
        for start in range(0, len(matrix), ROW_TILE):
            self._offer(rows.slice(start, ROW_TILE), matrix[start : start + ROW_TILE])

    def _offer(
        self,
        rows: pa.Table,
        matrix: np.ndarray,
        parts: Iterable[Part] | None = None,
        leaves: Leaves | None = None,
    ) -> None:
        if len(matrix) == 0:
            return
        longest = float(lengths_of(matrix).max(initial=0.0))
        dim = matrix.shape[1]
        reach = longest * float(self._lengths.max(initial=0.0))
        if reach < _FLOAT32_SAFE:
            queries, block = self._rough, matrix.astype(np.float32, copy=False)
            error = (dim + 8) * 2.0**-23
        else:
            queries, block = self._queries.astype(np.float64), matrix.astype(np.float64)
            error = (dim + 8) * 2.0**-52
        slack = self._lengths * (longest * error) + _ROUNDING
        order = _id_order(rows.column("id"))

        overlapping = parts is not None
        meeting = [
            (asked, held, block if held is None else block[held])
            for asked, held in (parts if overlapping else [(None, None)])
        ]
        for group in range(len(self._kept)):
            first, last = group * QUERY_GROUP, min((group + 1) * QUERY_GROUP, len(queries))
            pairs: list[np.ndarray] = []
            waiting = 0
            for asked, held, some in meeting:
                if asked is not None:
                    asked = asked[np.searchsorted(asked, first) : np.searchsorted(asked, last)]
                for found in self._candidates(queries, some, slack, asked, held, (first, last), leaves):
                    pairs.append(found)
                    waiting += len(found)
                    # Copies of one vector may all be candidates: no more than so many wait.
                    if waiting > PAIRS_AT_ONCE and not overlapping:
                        self._settle(group, rows, matrix, order, pairs)
                        waiting = 0
            self._settle(group, rows, matrix, order, pairs, overlapping)

    def _candidates(
        self,
        queries: np.ndarray,
        block: np.ndarray,
        slack: np.ndarray,
        asked: np.ndarray | None,
        held: np.ndarray | None,
        group: tuple[int, int],
        leaves: Leaves | None = None,
    ) -> Iterator[np.ndarray]:
        """``query << 32 | row`` of every pair that may be among the best, by tile."""
        if leaves is not None:
            yield from self._in_leaves(queries, block, slack, slice(*group), leaves)
            return
        first, count = (group[0], group[1] - group[0]) if asked is None else (0, len(asked))
        if count and self._floor[slice(*group) if asked is None else asked].min() > -np.inf:
            # Every query has k rows already, so few of this block's come up to them.
            for q in range(first, first + count, LATER_QUERIES):
                upto = min(q + LATER_QUERIES, first + count)
                query = slice(q, upto) if asked is None else asked[q:upto]
                done = yield from self._in_chunks(queries, block, slack, query, held)
                if done < len(block):
                    rest = np.arange(done, len(block)) if held is None else held[done:]
                    yield from self._in_tiles(queries, block[done:], slack, asked, rest, (q, upto))
        else:
            yield from self._in_tiles(queries, block, slack, asked, held, (first, first + count))

    def _in_order(self, matrix: np.ndarray) -> Leaves | None:
        """The rows of a block in leaves, if that spares enough of the scores."""
        if self._without:
            self._without -= 1
            return None
        longest = float(lengths_of(matrix).max(initial=0.0))
        reach = longest * float(self._lengths.max(initial=0.0))
        if len(matrix) < 2 * LEAF_ROWS or self.dim <= MAIN_AXES or not 0 < reach < _FLOAT32_SAFE:
            return None
        block = matrix.astype(np.float32, copy=False)
        if self._axes is None:
            _, axes = np.linalg.eigh(block.T.astype(np.float64) @ block)
            self._axes = axes[:, ::-1].astype(np.float32)
            turned = _along(self._rough, self._axes)
            # A column matters as much as the queries reach along it.
            self._weights = lengths_of(turned.T) / lengths_of(turned.T).max()
            main, rest = turned[:, :-1], turned[:, -1:]
            self._reach = np.hstack([np.maximum(main, 0), np.minimum(main, 0), rest])
        turned = _along(block, self._axes)
        order = _neighbours(turned / longest * self._weights, LEAF_ROWS)
        held = turned[order]
        high, low = held.max(axis=1), held.min(axis=1)
        bounds = np.hstack([high[:, :-1], low[:, :-1], high[:, -1:]])
        # Both sides are turned and multiplied in float32.
        error = self._lengths * (longest * (self.dim + 8) * self.dim**0.5 * 2.0**-22)
        found = Leaves(order, bounds, np.arange(order.size, len(block)), error)
        # Some of the queries tell for all.
        some = np.arange(0, len(self._queries), -(-len(self._queries) // LATER_QUERIES))
        if np.mean(self._may_win(some, found)) > 1 - SPARED:
            self._without = BLOCKS_WITHOUT
            return None
        return found

    def _may_win(self, query: slice | np.ndarray, leaves: Leaves) -> np.ndarray:
        """Whether a row of a leaf may come up to a query's floor, by leaf and query."""
        cut = self._threshold(query, leaves.error + _ROUNDING, np.dtype(np.float32))[:, 0]
        return leaves.bounds @ self._reach[query].T >= cut

    def _in_leaves(
        self,
        queries: np.ndarray,
        block: np.ndarray,
        slack: np.ndarray,
        query: slice,
        leaves: Leaves,
    ) -> Iterator[np.ndarray]:
        """The pairs of one group of queries, each leaf scored for the queries it may matter to."""
        names = np.arange(len(self._queries))[query]
        least = self._threshold(query, slack, queries.dtype)[:, 0]
        parts = [(np.flatnonzero(asked), rows) for asked, rows in zip(self._may_win(query, leaves), leaves.order)]
        every = np.arange(len(names))
        parts += [(every, leaves.rest[n : n + LATER_ROWS]) for n in range(0, len(leaves.rest), LATER_ROWS)]
        for asked, rows in parts:
            tile = block[rows]
            scores = self._room((len(rows), len(asked)), queries.dtype)
            np.matmul(tile, queries[names[asked]].T, out=scores)
            high = np.flatnonzero(scores.max(axis=0) >= least[asked])
            if len(high) > CHUNK_SHARE * len(asked):
                # Many qualify: the floors rise by this leaf's own best.
                yield from self._in_tiles(queries, tile, slack, names[asked], rows, (0, len(asked)))
                least = self._threshold(query, slack, queries.dtype)[:, 0]
            elif len(high):
                at, row = np.nonzero(scores[:, high].T >= least[asked[high], None])
                yield names[asked[high[at]]] << 32 | rows[row]

    def _in_chunks(
        self,
        queries: np.ndarray,
        block: np.ndarray,
        slack: np.ndarray,
        query: slice | np.ndarray,
        held: np.ndarray | None,
    ) -> Iterator[np.ndarray]:
        """The pairs of one tile of queries, found from the highest score of each CHUNK_ROWS
        rows. Returns how many rows of the block are done: fewer than all if too many chunks
        have a pair."""
        some = queries[query].T
        least = self._threshold(query, slack, queries.dtype)[:, 0]
        names = np.arange(len(self._queries))[query]
        for r in range(0, len(block), LATER_ROWS):
            tile = block[r : r + LATER_ROWS]
            scores = self._room((len(tile), some.shape[1]), queries.dtype)
            np.matmul(tile, some, out=scores)
            even = len(tile) // CHUNK_ROWS * CHUNK_ROWS
            for start, chunks in ((0, scores[:even].reshape(-1, CHUNK_ROWS, some.shape[1])), (even, scores[None, even:])):
                if not chunks.size:
                    continue
                high = np.flatnonzero(chunks.max(axis=1) >= least)
                if start == 0 and len(high) > CHUNK_SHARE * (chunks.shape[0] * some.shape[1]):
                    return r
                if len(high):
                    chunk, which = np.divmod(high, some.shape[1])
                    pair, row = np.nonzero(chunks[chunk, :, which] >= least[which, None])
                    row += r + start + chunk[pair] * CHUNK_ROWS
                    yield names[which[pair]] << 32 | (row if held is None else held[row])
        return len(block)

    def _in_tiles(
        self,
        queries: np.ndarray,
        block: np.ndarray,
        slack: np.ndarray,
        asked: np.ndarray | None,
        held: np.ndarray | None,
        part: tuple[int, int],
    ) -> Iterator[np.ndarray]:
        """The pairs of the queries from ``part[0]`` up to ``part[1]``, found from all scores."""
        first, count = part[0], part[1] - part[0]
        for q in range(first, first + count, QUERY_TILE):
            upto = min(q + QUERY_TILE, first + count)
            query = slice(q, upto) if asked is None else asked[q:upto]
            for r in range(0, len(block), ROW_TILE):
                tile = block[r : r + ROW_TILE]
                scores = self._room((upto - q, len(tile)), queries.dtype)
                np.matmul(queries[query], tile.T, out=scores)
                near = scores >= self._threshold(query, slack, scores.dtype)
                if len(tile) > self._k and np.count_nonzero(near) > 2 * self._k * len(scores):
                    # Many qualify: raise the floors by this tile's own best.
                    self._floor[query] = np.maximum(
                        self._floor[query], self._least_of_best(scores) - slack[query]
                    )
                    near = scores >= self._threshold(query, slack, scores.dtype)
                at = _marked(near)
                if len(at):
                    which, row = np.divmod(at, len(tile))
                    which = which + q if asked is None else asked[q:upto][which]
                    row = row + r if held is None else held[r : r + ROW_TILE][row]
                    yield which << 32 | row

    def _room(self, shape: tuple[int, int], kind: np.dtype) -> np.ndarray:
        """One piece of memory for the scores of all tiles."""
        needed = shape[0] * shape[1]
        if self._scores is None or self._scores.dtype != kind or len(self._scores) < needed:
            self._scores = np.empty(max(needed, QUERY_TILE * min(shape[1], ROW_TILE)), dtype=kind)
        return self._scores[:needed].reshape(shape)

    def _threshold(self, query: slice | np.ndarray, slack: np.ndarray, kind: np.dtype) -> np.ndarray:
        """What a rough score must reach, as a column in the scores' own type, rounded down."""
        cut = self._floor[query] - slack[query]
        if kind == np.float32:
            cut = np.nextafter(cut.astype(np.float32), np.float32(-np.inf))
        return cut[:, None]

    def _least_of_best(self, scores: np.ndarray) -> np.ndarray:
        """A score that at least ``k`` rows of the tile reach, for each query: the k-th of the
        maxima of chunks of rows."""
        rows = scores.shape[1]
        width = max(1, min(CHUNK_ROWS, rows // (4 * self._k)))
        chunks = rows // width
        most = scores[:, : chunks * width].reshape(len(scores), width, chunks).max(axis=1)
        return np.partition(most, chunks - self._k, axis=1)[:, chunks - self._k]

    def _settle(
        self,
        group: int,
        rows: pa.Table,
        matrix: np.ndarray,
        order: np.ndarray,
        pairs: list[np.ndarray],
        overlapping: bool = False,
    ) -> None:
        """Score the candidates exactly and keep the block's best. ``order`` has the rank of
        each row's id."""
        if not pairs:
            return
        pair = np.concatenate(pairs)
        pairs.clear()
        if overlapping:
            pair = np.unique(pair)
        for start in range(0, len(pair), PAIRS_AT_ONCE):
            some = pair[start : start + PAIRS_AT_ONCE]
            query, row = some >> 32, some & 0xFFFFFFFF
            score = np.empty(len(query))
            for at in range(0, len(query), 1 << 14):
                part = slice(at, at + (1 << 14))
                score[part] = np.einsum(
                    "ij,ij->i",
                    self._queries[query[part]].astype(np.float64, copy=False),
                    matrix[row[part]].astype(np.float64, copy=False),
                )
            # Adding 0.0 turns -0.0 into 0.0.
            score = np.round(score, SCORE_DIGITS) + 0.0
            # The block's own best first: only those rows are copied.
            here = _first_k(query, score, order[row], self._wanted)
            found = rows.take(pa.array(row[here]))
            found = found.append_column("query", pa.array(query[here].astype(np.int32)))
            found = found.append_column("score", pa.array(score[here]))
            self._pending[group].append(found)
            waiting = sum(table.num_rows for table in self._pending[group])
            kept = self._kept[group]
            # Few rows of a late block win; merge them once they are worth a sort.
            if kept is None or waiting > kept.num_rows // 2:
                self._merge(group)

    def _merge(self, group: int) -> None:
        """Merge the waiting rows of a group into its kept ones and raise the floors."""
        if not self._pending[group]:
            return
        kept = self._kept[group]
        tables = ([] if kept is None else [kept]) + self._pending[group]
        found, self._pending[group] = pa.concat_tables(tables).combine_chunks(), []
        if len(tables) > 1:
            found = found.take(pa.array(_first_k_by_id(found, self._wanted)))
        self._kept[group] = found
        first = group * QUERY_GROUP
        floor = self._floor[first : first + QUERY_GROUP]
        query, score = found.column("query").to_numpy() - first, found.column("score").to_numpy()
        count = np.bincount(query, minlength=len(floor))
        full = np.flatnonzero(count >= self._wanted[first : first + QUERY_GROUP])
        # The rows lie by query, the best first.
        lowest = score[np.cumsum(count)[full] - 1]
        floor[full] = np.maximum(floor[full], lowest - _ROUNDING)

    def tables(self) -> Iterator[pa.Table]:
        """The kept rows with ``query`` (position) and ``score`` appended, a group at a time."""
        for group in range(len(self._kept)):
            self._merge(group)
            if self._kept[group] is not None:
                yield self._kept[group]

    def table(self) -> pa.Table | None:
        """All of them at once."""
        tables = list(self.tables())
        return pa.concat_tables(tables).combine_chunks() if tables else None

    def count(self) -> int:
        """The rows kept or waiting."""
        kept = sum(table.num_rows for table in self._kept if table is not None)
        return kept + sum(table.num_rows for waiting in self._pending for table in waiting)

    def handed_over(self) -> None:
        """Forget the kept rows, which somebody else holds now. What they beat stays beaten."""
        floor = self._floor
        self._empty()
        self._floor = floor


def hits_tables(
    best: BestRows, query_ids: pa.Array | pa.ChunkedArray, rows: pa.Table
) -> Iterator[pa.Table]:
    """``query_id``, the columns of ``rows`` and ``score``, one line per kept row; a table for
    each group of queries."""
    for kept in best.tables():
        ids = query_ids.take(kept.column("query").combine_chunks())
        yield pa.table(
            [ids, *kept.select(rows.column_names).columns, kept.column("score")],
            names=["query_id", *rows.column_names, "score"],
        )


def hits_table(
    best: BestRows, query_ids: pa.Array | pa.ChunkedArray, rows: pa.Table
) -> pa.Table:
    """The tables of :func:`hits_tables` as one."""
    tables = list(hits_tables(best, query_ids, rows))
    if tables:
        return pa.concat_tables(tables)
    none = [query_ids.slice(0, 0), *rows.slice(0, 0).columns, pa.array([], pa.float64())]
    return pa.table(none, names=["query_id", *rows.column_names, "score"])


def _marked(near: np.ndarray) -> np.ndarray:
    """Positions that hold true in the flat array, few of many: looked up in words of eight."""
    flat = near.reshape(-1)
    if len(flat) % 8:
        return np.flatnonzero(flat)
    words = np.flatnonzero(flat.view(np.uint64))
    at, byte = np.nonzero(flat.reshape(-1, 8)[words])
    return words[at] * 8 + byte


def _id_order(ids: pa.ChunkedArray) -> np.ndarray:
    """Rank of each id; equal ids share a rank, and text compares by code point."""
    return pc.rank(ids, tiebreaker="dense").to_numpy()


def parts_by_cell(row_cells: np.ndarray, asking: dict[int, np.ndarray]) -> Iterable[Part]:
    """One part per cell that some query asks for: its queries and its rows.
    ``row_cells`` has the cells of each row, ``asking`` the queries of each cell."""
    width = row_cells.shape[1]
    flat = row_cells.reshape(-1)
    order = np.argsort(flat, kind="stable")
    cells, starts = np.unique(flat[order], return_index=True)
    for cell, start, stop in zip(cells, starts, [*starts[1:], len(flat)]):
        queries = asking.get(int(cell))
        if queries is not None:
            yield queries, order[start:stop] // width


def queries_by_cell(probes: list[np.ndarray]) -> dict[int, np.ndarray]:
    asking: dict[int, list[int]] = {}
    for query, cells in enumerate(probes):
        for cell in cells:
            asking.setdefault(int(cell), []).append(query)
    return {cell: np.array(queries) for cell, queries in asking.items()}
