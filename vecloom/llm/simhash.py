"""Operator 10: SimHash near-duplicates by bit-sliced comparison.

Equal fingerprints are one class from the start: everything after the fingerprints works on
distinct ones. Two fingerprints at most two bits apart agree on two of four 16-bit bands
at least, so each pair of bands is a bucket key and all rows of a bucket are compared.
A bucket's fingerprints are stored as 64 bit planes. Row i meets row i + d for all i at
once: planes shifted by d are xor-ed and added into carry-save counters, 64 pairs to a
machine word, and words whose pairs all exceed the radius leave the block early.
Tasks keep a spanning forest of the links they find; components are Spark jobs.

Null and empty texts have no words and the fingerprint zero, which links like any other.
Repeated rows share a fingerprint. Null ids never name a component (one whose ids are all
null has a null id). An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.llm.blocks import Forest, block_pairs, per_groups
from vecloom.llm.components import connected_components
from vecloom.session import settled

BLOCK_ROWS = 2048
RADIUS = 2
SHINGLES_AT_ONCE = 1 << 16


def _bit_sums(hashes: list[int]) -> np.ndarray:
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(0, dtype=np.int64)


def text_fingerprint(raw: bytes, words: int, seed: int) -> int:
    parts = raw.lower().split()
    n = len(parts) - words + 1
    if not parts:
        return 0
    if n <= 0:
        parts, n = [b" ".join(parts)], 1
        words = 1
    digest = xxhash.xxh64_intdigest
    sums = np.zeros(64, np.int64)
    for at in range(0, n, SHINGLES_AT_ONCE):
        some = parts[at : min(n, at + SHINGLES_AT_ONCE) + words - 1]
        sums += _bit_sums([digest(b" ".join(s), seed) for s in zip(*(some[i:] for i in range(words)), strict=False)])
    return int(((2 * sums > n).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum())


def fingerprint(text: Column, words: int = 3, seed: int = 42) -> Column:
    """The 64-bit SimHash of a text as a long (the bits, read as a signed number)."""

    @F.arrow_udf("bigint")
    def made(texts: pa.Array) -> pa.Array:
        raws = texts.cast(pa.binary()).to_pylist()
        prints = [text_fingerprint(raw or b"", words, seed) for raw in raws]
        return pa.array(np.array(prints, np.uint64).view(np.int64))

    return made(text)


def _exceeds(counters: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Pairs whose bit-sliced count is above the radius."""
    above, equal = over, ~np.zeros_like(over)
    for k in reversed(range(len(counters))):
        if radius >> k & 1:
            equal = equal & counters[k]
        else:
            above = above | equal & counters[k]
            equal = equal & ~counters[k]
    return above


def near_pairs(prints: np.ndarray, ends: np.ndarray, radius: int, forest: Forest | None = None):
    """Yield (i, j) arrays of rows within the radius.

    prints: a row of 64-bit words for each fingerprint. ends: end of each row's bucket. With
    a forest, pairs that it joins already are not compared.
    """
    prints = np.ascontiguousarray(prints).reshape(len(prints), -1)
    n, planes_many = len(prints), 64 * prints.shape[1]
    width = -(-n // 64)
    bits = np.zeros((width * 64, planes_many), np.uint8)
    bits[:n] = np.unpackbits(prints.view(np.uint8), axis=1, bitorder="little")
    planes = np.packbits(bits.T.copy(), axis=1, bitorder="little").view(np.uint64)
    planes = np.concatenate([planes, np.zeros((planes_many, 1), np.uint64)], axis=1)
    after = np.zeros(width * 64, np.int64)
    after[:n] = ends - np.arange(n) - 1
    per_word = after.reshape(-1, 64)
    longest = per_word.max(1, initial=0)
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    for d in range(1, int(longest.max(initial=0)) + 1):
        words = np.flatnonzero(longest >= d)
        wanted = per_word[words] >= d
        if forest is not None:
            rows = np.minimum(words[:, None] * 64 + np.arange(64), n - 1)
            wanted &= forest.up[rows] != forest.up[np.minimum(rows + d, n - 1)]
            some = wanted.any(1)
            words, wanted = words[some], wanted[some]
            if not len(words):
                continue
        met = np.packbits(wanted, axis=1, bitorder="little").view(np.uint64)[:, 0]
        jump, shift = divmod(d, 64)
        near = np.minimum(words + jump, width)
        far = np.minimum(words + jump + 1, width)
        over = ~met
        counters = [np.zeros(len(words), np.uint64) for _ in range(radius.bit_length() or 1)]
        for plane in range(planes_many):
            row = planes[plane]
            other = row[near]
            if shift:
                other = other >> np.uint64(shift) | row[far] << np.uint64(64 - shift)
            carry = row[words] ^ other
            for counter in counters:
                carry, counter[:] = counter & carry, counter ^ carry
            over |= carry
            if plane % 8 == 7:
                exceeded = _exceeds(counters, over, radius)
                live = exceeded != full
                if not live.all():
                    words, near, far, over = words[live], near[live], far[live], exceeded[live]
                    counters = [c[live] for c in counters]
                    if not len(words):
                        break
        if len(words):
            exceeded = _exceeds(counters, over, radius)
            found = np.unpackbits((~exceeded).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            word, bit = np.nonzero(found)
            i = words[word] * 64 + bit
            yield i, i + d


def links(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK_ROWS) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints within the radius, 2 at most: two
    bits leave two of four bands alike, more need not."""
    if not 0 <= radius <= RADIUS:
        raise ValueError(f"the radius must be between 0 and {RADIUS}")
    band = [F.shiftrightunsigned("fingerprint", 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(4)]
    pairs = [(i, j) for i in range(4) for j in range(i + 1, 4)]
    keys = [
        F.lit(n << 32).bitwiseOR(F.shiftleft(band[i], 16)).bitwiseOR(band[j]) for n, (i, j) in enumerate(pairs)
    ]
    rows = prints.select(F.explode(F.array(*keys)).alias("bucket"), "fingerprint")

    def compared(joined: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        values = joined.column("fingerprint").to_numpy()
        ends = np.repeat(starts[1:], np.diff(starts))
        forest = Forest(len(values))
        for i, j in near_pairs(np.ascontiguousarray(values).view(np.uint64), ends, radius, forest):
            forest.link(i, j)
        kept = np.array(forest.kept, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(values[kept[:, 0]]), pa.array(values[kept[:, 1]])], ["a", "b"])

    met = block_pairs(rows, block, ["fingerprint"], "fingerprint")
    return met.mapInArrow(per_groups(compared), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    radius: int = RADIUS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, *keep, fingerprint, component_id, component) for every row of docs.

    component_id is the smallest id of the component, component its own number, which it has
    even if all its ids are null.
    """
    made = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.struct(F.lit(0).alias("_"), *keep).alias("others"),
        fingerprint(F.col(text)).alias("fingerprint"),
    )
    made = settled(made, "prints")
    classes = settled(made.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "classes")
    parts = connected_components(links(classes.select("fingerprint"), radius), "a", "b")
    named = classes.join(parts, classes.fingerprint == parts.node, "left").select(
        "fingerprint", "first", F.coalesce("component", "fingerprint").alias("component")
    )
    named = settled(named, "components")
    lowest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = named.join(lowest, "component").select("fingerprint", "component_id", "component")
    return made.join(named, "fingerprint").select(
        "doc_id", *(F.col("others")[c].alias(c) for c in keep), "fingerprint", "component_id", "component"
    )
