"""Operator 9: repeated passages, found by FM-indexes over shards.

A window is ``window`` consecutive words of one document. Words covered by a window whose
words also start earlier (smaller id, or same document and earlier start) are removed.

Shards by content. Each window has an anchor: the least hash of the short word runs inside
it. Equal windows have equal anchors, so they meet in one shard if text is routed by
anchor; consecutive windows of one anchor travel together as a segment. An anchor that
stands at one place only holds no repeat, so only segments of the others are cut out. Equal
segments are one row before they reach a shard (with their earliest place and count).

In a shard the distinct segments are indexed (fm_index.py) and streamed against it:
backward search over the wavelet matrix takes each window as long as more than one
suffix still matches, and windows that stay matched over the whole length have their
earliest place from the suffixes found. An anchor with more than BLOCK_ROWS distinct
segments is cut into blocks, and each two of its blocks share a shard.

Documents with equal words are one class from the start: the later ones repeat the first
as a whole. Texts are shuffled once, compressed, for all steps.

Null and empty texts have no words. A null id counts as larger than all others. Rows with
equal id and equal words are the same document; rows with one id and other words are told
apart, and neither is earlier at the same start. An empty table gives no rows. Columns
named in ``keep`` are carried; the others are not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from vecloom.llm.blocks import GROUP, whole_groups
from vecloom.llm.common import bucketed, written
from vecloom.llm.fm_index import FMIndex
from vecloom.llm.words import mixed, word_hashes

WINDOW = 20
ANCHOR_WORDS = 5
# Windows of one segment at most; text that repeats itself has long runs of one anchor.
SEGMENT_WINDOWS = 32
BLOCK_ROWS = 4096
SHARD_ROWS = 1 << 13
LAST = 2**63 - 1


@F.arrow_udf(BinaryType())
def _word_digest(texts: pa.Array) -> pa.Array:
    raws = texts.cast(pa.binary()).to_pylist()
    return pa.array([hashlib.md5(b" ".join((r or b"").split())).digest() for r in raws], pa.binary())


@F.arrow_udf(BinaryType())
def _compressed(texts: pa.Array) -> pa.Array:
    packer = zstandard.ZstdCompressor(level=1)
    return pa.array([packer.compress(r or b"") for r in texts.cast(pa.binary()).to_pylist()], pa.binary())


def _texts(column: pa.Array) -> Iterator[bytes]:
    unpacker = zstandard.ZstdDecompressor()
    for value in column:
        yield unpacker.decompress(value.as_py())


def _sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    span = 1
    while span < width:
        step = min(span, width - span)
        values = pick(values[:-step], values[step:])
        span += step
    return values


def _run_hashes(words: np.ndarray, window: int) -> tuple[np.ndarray, int]:
    """The hash of the short run of words at each word, and how many a window holds."""
    short = min(ANCHOR_WORDS, window)
    runs = words[: len(words) - short + 1].copy()
    with np.errstate(over="ignore"):
        for i in range(1, short):
            runs = mixed(runs * np.uint64(0x9E3779B97F4A7C15) + words[i : len(words) - short + 1 + i])
    return runs, window - short + 1


def anchors(raw: bytes, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchors of a text, and at how many places each stands.

    Windows that repeat in one segment have the anchor at several places of it.
    """
    words = word_hashes(raw)[2]
    if len(words) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    runs, inside = _run_hashes(words, window)
    least = _sliding(runs, inside, np.minimum)
    edge = np.zeros(inside - 1, np.uint64)
    # A run of words is an anchor if it is the least of some window that it lies in.
    chosen = _sliding(np.r_[edge, least, edge], inside, np.maximum) == runs
    found, counts = np.unique(runs[chosen], return_counts=True)
    return found.view(np.int64), counts


def segments(raw: bytes, window: int) -> tuple[np.ndarray, ...]:
    """(anchor, first window, windows, word start, word end) of a text's segments."""
    starts, ends, words = word_hashes(raw)
    windows = len(words) - window + 1
    if windows < 1:
        none = np.zeros(0, np.int64)
        return none, none, none, starts, ends
    least = _sliding(*_run_hashes(words, window), np.minimum).view(np.int64)
    first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    lengths = np.diff(np.r_[first, windows])
    pieces = -(-lengths // SEGMENT_WINDOWS)
    if (pieces > 1).any():
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = np.repeat(first, pieces) + nth * SEGMENT_WINDOWS
        lengths = np.minimum(SEGMENT_WINDOWS, np.repeat(first + lengths, pieces) - begin)
        first = begin
    return least[first], first, lengths, starts, ends


def _anchors(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, counts = [], []
            for raw in _texts(batch.column(1)):
                found, many = anchors(raw, window)
                values.append(found)
                counts.append(many)
            if values:
                owner = np.repeat(np.arange(len(values)), [len(v) for v in values])
                anchor, n = (pa.array(np.concatenate(x).astype(np.int64)) for x in (values, counts))
                rows = batch.column(0).take(pa.array(owner))
                yield pa.RecordBatch.from_arrays([anchor, rows, n], ["anchor", "row", "n"])

    return run


def _cut(window: int):
    """Every segment of a repeated anchor: its words, a key for them, and its place."""
    names = ["anchor", "key", "content", "row", "at", "place"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]

    def packed(out: list[tuple]) -> pa.RecordBatch:
        columns = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            rows, ids, wanted = (batch.column(i) for i in (0, 1, 2))
            for row, at, repeated, raw in zip(
                rows.to_pylist(), ids.to_pylist(), wanted, _texts(batch.column(3)), strict=True
            ):
                anchor, first, many, starts, ends = segments(raw, window)
                chosen = np.flatnonzero(np.isin(anchor, repeated.values.to_numpy()))
                begin = starts[first[chosen]].tolist()
                end = ends[first[chosen] + many[chosen] + window - 2].tolist()
                for a, place, s, e in zip(
                    anchor[chosen].tolist(), first[chosen].tolist(), begin, end, strict=True
                ):
                    content = b" ".join(raw[s:e].split())
                    out.append((a, xxhash.xxh64_intdigest(content) - 2**63, content, row, at, place))
                if len(out) >= 20_000:
                    yield packed(out)
                    out = []
            if out:
                yield packed(out)

    return run


def shard_matches(contents: list[bytes], at: np.ndarray, place: np.ndarray, n: np.ndarray, window: int):
    """Pieces (content, from, to, at, place): windows from..to of a content start earliest
    at place, place + 1, .. of document ``at``; only what removes some occurrence."""
    words = b" ".join(contents).split()
    sizes = np.fromiter((c.count(b" ") + 1 for c in contents), np.int64, len(contents))
    codes = pd.factorize(np.array(words, dtype=object))[0] + 1
    ends = np.cumsum(sizes + 1) - 1
    symbols = np.zeros(int(ends[-1]) + 1, np.int64)
    inside = np.ones(len(symbols), bool)
    inside[ends] = False
    symbols[inside] = codes
    index = FMIndex(symbols, window)
    windows = sizes - window + 1
    owner = np.repeat(np.arange(len(sizes)), windows)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    begin = (ends - sizes)[owner] + offset
    which, low, high = index.search(symbols, begin + window, window)
    # The earliest place of each window: its own content's, or that of another suffix.
    best_at, best_place = at[owner].copy(), place[owner] + offset
    found = n[owner] > 1
    if len(which):
        spans, back = np.unique(np.stack([low, high], 1), axis=0, return_inverse=True)
        back = back.ravel()
        content_of = np.repeat(np.arange(len(sizes)), sizes + 1)
        word_of = np.arange(len(symbols)) - np.repeat(ends - sizes, sizes + 1)
        suffix = index.suffixes[_ranges(spans[:, 0], spans[:, 1])]
        group = np.repeat(np.arange(len(spans)), spans[:, 1] - spans[:, 0])
        order = np.lexsort((place[content_of[suffix]] + word_of[suffix], at[content_of[suffix]], group))
        first = order[np.searchsorted(group[order], np.arange(len(spans)))]
        first_at, first_place = at[content_of[suffix[first]]], (place[content_of] + word_of)[suffix[first]]
        new_at, new_place = first_at[back], first_place[back]
        earlier = (new_at < best_at[which]) | (new_at == best_at[which]) & (new_place < best_place[which])
        best_at[which[earlier]], best_place[which[earlier]] = new_at[earlier], new_place[earlier]
        found[which[earlier]] = True
    keep = np.flatnonzero(found)
    o, i, a, p = owner[keep], offset[keep], best_at[keep], best_place[keep]
    fresh = np.ones(len(keep), bool)
    fresh[1:] = (np.diff(o) != 0) | (np.diff(i) != 1) | (np.diff(a) != 0) | (np.diff(p) != 1)
    s = np.flatnonzero(fresh)
    e = np.r_[s[1:], len(keep)] - 1 if len(s) else s
    return o[s], i[s], i[e] + 1, a[s], p[s]


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    sizes = high - low
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1])) + np.repeat(low - (ends - sizes), sizes)


def _shards(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for joined, _ in whole_groups(batches, SHARD_ROWS):
            # A segment may be here for several pairs of blocks of its anchor.
            found = {}
            contents = joined.column("content").to_pylist()
            for i, pair in enumerate(zip(joined.column("anchor").to_pylist(), contents, strict=True)):
                found.setdefault(pair, i)
            chosen = np.fromiter(found.values(), np.int64, len(found))
            anchor, at, place, n = (joined.column(c).to_numpy()[chosen] for c in ("anchor", "at", "place", "n"))
            contents = [contents[i] for i in chosen.tolist()]
            o, start, end, first_at, first_place = shard_matches(contents, at, place, n, window)
            keys = [xxhash.xxh64_intdigest(contents[i]) - 2**63 for i in o.tolist()]
            arrays = [anchor[o], np.array(keys, np.int64), start, end, first_at, first_place]
            names = ["anchor", "key", "from", "to", "first_at", "first_place"]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in arrays], names)

    return run


def _removal(window: int, restore: bool) -> Column:
    @F.arrow_udf("struct<n_words:bigint,n_removed:bigint,kept:string>")
    def removed(packed: pa.Array, is_first: pa.Array, spans: pa.Array) -> pa.Array:
        n_words, n_removed, kept = [], [], []
        for raw, first, found in zip(_texts(packed), is_first.to_pylist(), spans, strict=True):
            words = raw.split()
            keep = np.ones(len(words) + 1, bool)
            if not first and len(words) >= window:
                keep[:] = False
            elif found.is_valid and len(found.values):
                edges = np.zeros(len(words) + 1, np.int64)
                low, high = (found.values.field(c).to_numpy() for c in ("low", "high"))
                inside = high <= len(words)
                np.add.at(edges, low[inside], 1)
                np.add.at(edges, high[inside], -1)
                keep = np.cumsum(edges) == 0
            gone = len(words) - int(keep[: len(words)].sum())
            n_words.append(len(words))
            n_removed.append(gone)
            if gone:
                words = [w for w, k in zip(words, keep.tolist(), strict=False) if k]
            kept.append((raw if restore and not gone else b" ".join(words)).decode("utf-8", "replace"))
        return pa.StructArray.from_arrays(
            [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
            ["n_words", "n_removed", "kept"],
        )

    return removed(F.col("packed"), F.col("is_first"), F.col("spans"))


def remove_repeats(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    keep: tuple[str, ...] = (),
    window: int = WINDOW,
    restore: bool = False,
) -> DataFrame:
    """(doc_id, *keep, n_words, n_removed, kept): the text that is left of every row.

    ``kept`` has the kept words joined by one space; with ``restore``, a text that loses
    nothing stays as it was.
    """
    base = df.select(
        F.col(doc_id).alias("doc_id"),
        F.struct(F.lit(0).alias("_"), *keep).alias("others"),
        F.coalesce(F.col(doc_id).cast("bigint"), F.lit(LAST)).alias("at"),
        _word_digest(F.col(text)).alias("digest"),
        _compressed(F.col(text)).alias("packed"),
    )
    # 128 bits, as the digest itself: documents are not mixed up at any size.
    row = F.unhex(F.md5(F.concat(F.encode(F.col("at").cast("string"), "UTF-8"), "digest"))).alias("row")
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    texts = bucketed(base.select("*", row), "row", size)
    firsts = texts.groupBy("digest").agg(F.min("at").alias("at")).select(row)
    first_texts = texts.join(firsts, "row", "left_semi")

    anchored = first_texts.select("row", "packed").mapInArrow(_anchors(window), "anchor bigint, row binary, n bigint")
    anchored = written(anchored, "anchors")
    repeated = anchored.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor")
    wanted = anchored.join(repeated, "anchor", "left_semi").groupBy("row").agg(F.collect_list("anchor").alias("anchors"))
    searched = first_texts.join(bucketed(wanted, "row", size), "row").select("row", "at", "anchors", "packed")

    kind = "anchor bigint, key bigint, content binary, row binary, at bigint, place bigint"
    places = written(searched.mapInArrow(_cut(window), kind), "segments")
    order = F.col("at").cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(10,0)") + F.col("place")
    contents = places.groupBy("anchor", "content").agg(
        F.count(F.lit(1)).alias("n"), F.min("at").alias("at"), F.min_by("place", order).alias("place")
    )
    contents = written(contents, "contents")
    hot = contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > BLOCK_ROWS)
    blocks = F.coalesce(F.ceil(F.col("rows") / BLOCK_ROWS).cast("int"), F.lit(1))
    dealt = (
        contents.join(hot, "anchor", "left")
        .select("*", blocks.alias("blocks"))
        .withColumn("mine", F.pmod(F.xxhash64("content"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.col("anchor").alias("bucket"),
            F.least("mine", "other").alias("left"),
            F.greatest("mine", "other").alias("right"),
            "anchor",
            "content",
            "at",
            "place",
            "n",
        )
    )
    sharded = dealt.repartition(*GROUP).sortWithinPartitions(*GROUP)
    kind = "anchor bigint, key bigint, from bigint, to bigint, first_at bigint, first_place bigint"
    matches = sharded.mapInArrow(_shards(window), kind)

    low = F.col("place") + F.col("from")
    earlier = (F.col("first_at") < F.col("at")) | (F.col("first_at") == F.col("at")) & (F.col("first_place") < low)
    spans = (
        places.drop("content")
        .join(matches, ["anchor", "key"])
        .where(earlier)
        .select("row", low.alias("low"), (F.col("place") + F.col("to") + window - 1).alias("high"))
        .groupBy("row")
        .agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    )
    found = (
        texts.join(firsts.withColumn("is_first", F.lit(True)), "row", "left")
        .join(spans, "row", "left")
        .withColumn("is_first", F.coalesce("is_first", F.lit(False)))
    )
    done = found.select("doc_id", "others", _removal(window, restore).alias("r"))
    return done.select("doc_id", *(F.col("others")[c].alias(c) for c in keep), "r.*")
