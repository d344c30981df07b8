"""Operator 13: drawing the documents of a corpus that look most like a target.

Runs of one to three words fall into hash buckets. A bucket's gain is the logarithm of its
share in the target over its share in the corpus; a document's weight is the sum of the
gains of its runs, taken from an array. With Gumbel noise from a hash of its id added, the
highest scores are a draw without replacement in proportion to the weights.

Which scores are the highest is found without sorting the corpus: a quantile sketch gives a
bracket around the cutoff, exact counts of the rows above and inside it say whether the
cutoff is really there (else the bracket is widened), and only the bracket is sorted. The
counting and the scoring pass read each text once; what reaches the driver is one number per
bucket, and what is sorted for the ranks are the rows drawn. Ties go to the smaller id.

Null and empty texts have no words, no features and the weight 0. Null ids have the noise of
an empty one and come after all others. Repeated rows are drawn each; which of two that are
alike in all that decides goes first is fixed by their place in the written scores. Empty
tables: no documents give no rows, an empty target gives all buckets its smoothed share.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vecloom.llm.word_runs import runs
from vecloom.session import settled

BUCKETS = 10_000
PERCENT = 5
LEAST_WORDS = 20
SEED = 42
# The sketch's relative error is 1 / ACCURACY; the first bracket is MARGIN of them each way.
ACCURACY = 10_000
MARGIN = 4


def utf8(texts: pa.Array) -> Iterator[bytes]:
    return (raw or b"" for raw in texts.cast(pa.binary()).to_pylist())


def bucket_counts(texts: DataFrame, text: str, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, crc, _ in runs(utf8(batch.column(0))):
                total += np.bincount(crc % buckets, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    partial = texts.select(text).mapInArrow(count, "bucket bigint, n bigint")
    found = np.zeros(buckets, np.int64)
    for row in partial.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        found[row.bucket] = row.n
    return found


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the logarithm of each bucket's share in the target over that in the corpus,
    with one added to each count, rounded down."""
    smoothed = len(corpus)
    of_corpus, of_target = float(corpus.sum() + smoothed), float(target.sum() + smoothed)
    pairs = zip(corpus.tolist(), target.tolist(), strict=True)
    return np.array([math.floor(1000 * math.log((t + 1) * of_corpus / ((s + 1) * of_target))) for s, t in pairs])


def weighed(text: Column, gain: np.ndarray) -> Column:
    """(n_words, n_features, weight) of a text."""

    @F.arrow_udf("struct<n_words:bigint,n_features:bigint,weight:bigint>")
    def weigh(texts: pa.Array) -> pa.Array:
        words, features, weight = (np.zeros(len(texts), np.int64) for _ in range(3))
        for of, crc, owner in runs(utf8(texts)):
            words += np.bincount(owner, minlength=len(texts))
            features += np.bincount(of, minlength=len(texts))
            # Sums of whole numbers far below 2**53: exact.
            weight += np.bincount(of, gain[crc % len(gain)], len(texts)).astype(np.int64)
        return pa.StructArray.from_arrays(
            [pa.array(words), pa.array(features), pa.array(weight)], ["n_words", "n_features", "weight"]
        )

    return weigh(text)


def noise(doc_id: Column, seed: int) -> Column:
    """1000 times the Gumbel noise that a hash of the id gives, rounded down."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("long")


def order() -> list[Column]:
    return [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]


def numbered(rows: DataFrame, label: str) -> DataFrame:
    """The rows and their place, from 1, in the order of the scores: ranges of it are sorted in
    parallel and written, then numbered on from the sizes of the ranges before."""
    ranges = rows.repartitionByRange(*order()).withColumn("range", F.spark_partition_id())
    dealt = settled(ranges, label)
    sizes = dealt.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("range")) - F.col("n")
    # As many rows as the shuffle had partitions.
    starts = F.broadcast(sizes.select("range", before.alias("before")))
    inside = F.row_number().over(Window.partitionBy("range").orderBy(*order()))
    return dealt.join(starts, "range").withColumn("place", F.col("before") + inside).drop("range", "before")


def bracket(rows: DataFrame, percent: float, margin: float) -> tuple[float | None, float | None]:
    """Scores around the one that ``percent`` of the rows reach, by a quantile sketch; None
    where the bracket is open."""
    at, reach = 1 - percent / 100, margin / ACCURACY
    asked = [max(0.0, at - reach), min(1.0, at + reach)]
    low, high = rows.agg(F.percentile_approx("score", asked, ACCURACY)).first()[0] or (None, None)
    return (low if asked[0] > 0 else None), (high if asked[1] < 1 else None)


def cutoff(rows: DataFrame, percent: int) -> tuple | None:
    """The last row drawn, as (score, doc_id, row); None if there is none to draw."""
    draws = percent * rows.count() // 100
    margin = float(MARGIN)
    while draws:
        low, high = bracket(rows, percent, margin)
        above = F.lit(False) if high is None else F.col("score") > high
        below = F.lit(False) if low is None else F.col("score") < low
        higher, lower_too = rows.agg(F.count_if(above), F.count_if(~below)).first()
        if higher < draws <= lower_too:
            inside = numbered(rows.where(~above & ~below), "bracket")
            return tuple(inside.where(F.col("place") == draws - higher).select("score", "doc_id", "row").first())
        margin *= 8
    return None


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    keep: tuple[str, ...] = (),
    seed: int = SEED,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """(doc_id, *keep, n_words, n_features, weight, score, rank) for every document: the rank of
    those drawn, ``percent`` of the documents of enough words, is 1, 2, 3.. from the highest
    score; null for the others."""
    gain = gains(bucket_counts(docs, text), bucket_counts(target, target_text))
    made = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.struct(F.lit(0).alias("_"), *keep).alias("others"),
        weighed(F.col(text), gain).alias("w"),
    ).select("doc_id", "others", "w.*")
    made = made.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = settled(made.withColumn("row", F.monotonically_increasing_id()), "scores")
    enough = F.col("n_words") >= least_words
    last = cutoff(scored.where(enough).select("score", "doc_id", "row"), percent)
    drawn = F.lit(False)
    if last is not None:
        score, name, row = map(F.lit, last)
        same = F.col("doc_id").eqNullSafe(name) & (F.col("row") <= row)
        smaller = F.col("doc_id").isNotNull() if last[1] is None else F.coalesce(F.col("doc_id") < name, F.lit(False))
        drawn = enough & ((F.col("score") > score) | ((F.col("score") == score) & (smaller | same)))
    ranked = numbered(scored.where(drawn), "drawn").withColumnRenamed("place", "rank")
    rest = scored.where(~drawn).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select(
        "doc_id", *(F.col("others")[c].alias(c) for c in keep), "n_words", "n_features", "weight", "score", "rank"
    )
