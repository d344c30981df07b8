"""Operator 8: packing token sequences by large-item matching and best fit.

Lengths are whole numbers up to the capacity, so the whole packing is decided from the
histogram of lengths, which has at most ``capacity`` rows however many documents there are.
Pieces above a third of the capacity are matched greedily, two to a bin at most: the
longest with the longest that fits beside it. Smaller ones, longest first, go to the
smallest gap that holds them, and to new bins when none does. Bins that look alike are
handled together as a range of bin numbers, so the plan is a short list of rules
"the r-th piece of length l lies in this bin at this offset".

Each piece then needs its rank among the pieces of its length: the pieces are dealt into
buckets of bounded size by a hash, counted per (bucket, length), and numbered inside them.
No length, however common, meets in one task.

A null text is empty and takes one token, the end mark. Repeated rows are packed each.
An empty table gives no rows. Columns other than the id and the text are not carried.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vecloom.llm.encoder import tokenizer_file, worker_encoder
from vecloom.session import settled

BUCKET_ROWS = 20_000


def packing_rules(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Rules (length, first rank, first bin, pieces to a bin, offset of the first).

    Ordered by length and rank; a rule holds up to the next rule of its length. Bins are
    numbered from 0 without gaps.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    used: dict[int, int] = defaultdict(int)
    rules: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)
    bins = 0

    def place(length: int, pieces: int, first_bin: int, each: int, offset: int) -> None:
        rules.append((length, used[length], first_bin, each, offset))
        used[length] += pieces

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        length = large[-1]
        at = bisect.bisect_right(large, capacity - length) - 1
        partner = large[at] if at >= 0 else 0
        if partner == length and left[length] < 2:
            partner = large[at - 1] if at > 0 else 0
        if partner == length:
            many = left[length] // 2
            place(length, 2 * many, bins, 2, 0)
            left[length] -= 2 * many
        else:
            many = min(left[length], left[partner]) if partner else left[length]
            place(length, many, bins, 1, 0)
            left[length] -= many
            if partner:
                place(partner, many, bins, 1, length)
                left[partner] -= many
        gaps[capacity - length - partner].append((bins, many))
        bins += many
        large = [n for n in large if left[n]]

    small = sorted((n for n in left if 3 * n <= capacity and left[n]), reverse=True)
    sizes = sorted(gaps)
    for length in small:
        n = left[length]
        at = bisect.bisect_left(sizes, length)
        while n:
            if at < len(sizes):
                gap = sizes[at]
                ranges = gaps[gap]
                if not ranges:
                    at += 1
                    continue
                first, many = ranges.pop()
            else:
                gap, first, many = capacity, bins, -(-n // (capacity // length))
                bins += many
            each = gap // length
            full = min(many, n // each)
            if full:
                place(length, full * each, first, each, capacity - gap)
                gaps[gap - each * length].append((first, full))
                n -= full * each
            rest = min(n, each - 1) if full < many else 0
            if rest:
                place(length, rest, first + full, rest, capacity - gap)
                gaps[gap - rest * length].append((first + full, 1))
                n -= rest
            untouched = many - full - (1 if rest else 0)
            if untouched:
                gaps[gap].append((first + many - untouched, untouched))
        sizes = sorted(g for g, ranges in gaps.items() if ranges)
    return sorted(rules)


def pieces(
    df: DataFrame, tokenizer: str, capacity: int, end_id: int, doc_id: str, text: str, keep_ids: bool
) -> DataFrame:
    """The pieces of every text: ids and the end mark, cut from the end into full pieces."""
    spec = tokenizer_file(tokenizer)
    fields = "piece:int,start:bigint,length:bigint,ids_crc32:bigint" + (",ids:array<int>" if keep_ids else "")

    @F.arrow_udf(f"array<struct<{fields}>>")
    def cut(texts: pa.Array) -> pa.Array:
        ends, piece, start, length, crc, values = [0], [], [], [], [], []
        for ids in worker_encoder(spec).encode_column(texts):
            ids = np.append(ids, np.uint32(end_id)).astype("<u4")
            head = len(ids) % capacity or capacity
            edges = [0, *range(head, len(ids) + 1, capacity)]
            for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                piece.append(i)
                start.append(a)
                length.append(b - a)
                crc.append(zlib.crc32(ids[a:b].tobytes()))
                if keep_ids:
                    values.append(ids[a:b].astype(np.int32))
            ends.append(len(piece))
        columns = [pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
        names = ["piece", "start", "length", "ids_crc32"]
        if keep_ids:
            columns.append(pa.array(values, pa.list_(pa.int32())))
            names.append("ids")
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, names))

    found = df.select(F.col(doc_id).alias("doc_id"), F.explode(cut(F.col(text))).alias("p"))
    return found.select("doc_id", "p.*")


def pack(
    df: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    end_id: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece with its sequence and its offset there (and its ids, if kept)."""
    found = settled(pieces(df, tokenizer, capacity, end_id, doc_id, text, keep_ids), "pieces")
    # At most `capacity` rows reach the driver.
    counts = {r.length: r["count"] for r in found.groupBy("length").count().collect()}
    rules = np.array(packing_rules(counts, capacity), np.int64).reshape(-1, 5)
    buckets = -(-sum(counts.values()) // BUCKET_ROWS) or 1
    order = ["doc_id", "piece", "start", "ids_crc32"]
    dealt = found.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    before = (
        dealt.groupBy("length", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n"))
        .drop("n")
    )
    # Ranks must not change when a task is run again: equal rows are interchangeable.
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy(*order)) - 1
    ranked = dealt.withColumn("inside", inside).join(before, ["length", "bucket"])
    keys = rules[:, 0] << 44 | rules[:, 1]

    @F.arrow_udf("struct<sequence_id:bigint,offset:bigint>")
    def slot(length: pa.Array, rank: pa.Array) -> pa.Array:
        length, rank = (x.to_numpy(zero_copy_only=False) for x in (length, rank))
        rule = rules[np.searchsorted(keys, length << 44 | rank, "right") - 1]
        nth = rank - rule[:, 1]
        return pa.StructArray.from_arrays(
            [pa.array(rule[:, 2] + nth // rule[:, 3]), pa.array(rule[:, 4] + nth % rule[:, 3] * length)],
            ["sequence_id", "offset"],
        )

    placed = ranked.withColumn("slot", slot("length", F.col("before") + F.col("inside")))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else []), "slot.*")
