"""Operator 11: exact duplicates by skew-safe combining, with SQL functions alone.

Texts are equal when they are identical once every run of white space is one space. Copies
are combined in three steps, and each compares the whole content beside its digest:

1. locally: the map side of the grouping leaves one row per content and task;
2. per salt: a digest that holds more than one row in HOT_GROUPS of the table gets SALTS
   salts, dealt by task, so its local winners meet in many reducers. Any other digest has
   one salt, which settles it: texts are shuffled once;
3. globally: the winners of a hot digest's salts, at most SALTS rows for each content.

Rows then look up their group by the digest. Digests that turned out to hold two contents
are looked up by content as well. There are fewer than HOT_GROUPS hot digests, whatever the
table's size, so they are broadcast and their rows are not shuffled.

A null text is the empty text. Null ids come after all others: a group keeps one only if it
has no other id, and then all its rows stay, as nothing tells them apart. Rows that repeat
the smallest id of their group are one document and all stay. An empty table gives no rows.
Columns other than the id and the text are carried only if they are named in ``keep``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.session import settled

HOT_GROUPS = 10_000
SALTS = 64


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def combined(rows: DataFrame, *keys: str) -> DataFrame:
    """(keys, first, n): the smallest id and the number of rows of each group."""
    return rows.groupBy(*keys).agg(F.min("first").alias("first"), F.sum("n").alias("n"))


def one_content(rows: DataFrame) -> DataFrame:
    """(digest, contents, first, n) from rows of one content each."""
    return rows.groupBy("digest").agg(
        F.count(F.lit(1)).alias("contents"), F.min("first").alias("first"), F.sum("n").alias("n")
    )


def find_copies(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    keep: tuple[str, ...] = (),
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """(doc_id, *keep, keep_id, group_size, kept, digest) for every row of docs.

    ``digest`` maps a normalised text to what stands for it; contents that share one are
    still told apart.
    """
    texts = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.struct(F.lit(0).alias("_"), *keep).alias("others"),
        normalised(F.col(text)).alias("content"),
    ).withColumn("digest", digest(F.col("content")))
    rows = settled(texts.select("doc_id", "others", "digest"), "rows")
    share = F.lit(rows.count()) / HOT_GROUPS
    many = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("rows"))
    hot = settled(many.where((F.col("rows") > 1) & (F.col("rows") > share)).select("digest"), "hot")

    salt = F.pmod(F.spark_partition_id(), F.lit(SALTS))
    marked = texts.join(F.broadcast(hot.withColumn("hot", F.lit(True))), "digest", "left")
    salted = marked.select(
        "digest",
        "content",
        F.when(F.col("hot"), salt).otherwise(F.lit(-1)).alias("salt"),
        F.col("doc_id").alias("first"),
        F.lit(1).alias("n"),
    )
    local = combined(salted, "digest", "content", "salt")
    # The contents of digests with one salt are settled and stay behind.
    kept = local.select("digest", F.when(F.col("salt") >= 0, F.col("content")).alias("content"), "first", "n")
    winners = settled(kept, "winners")
    over_salts = combined(winners.where(F.col("content").isNotNull()), "digest", "content")
    groups = one_content(winners.where(F.col("content").isNull())).withColumn("hot", F.lit(False))
    groups = settled(groups.union(one_content(over_salts).withColumn("hot", F.lit(True))), "groups")

    alone = groups.where("contents = 1").select("digest", "first", "n", "hot")
    hot_groups, cold_groups = (alone.where(F.col("hot") == flag).drop("hot") for flag in (True, False))
    settled_hot = rows.join(F.broadcast(hot_groups), "digest")
    found = settled_hot.unionByName(rows.join(F.broadcast(hot), "digest", "left_anti").join(cold_groups, "digest"))
    shared = groups.where("contents > 1").select("digest")
    if not shared.isEmpty():
        found = found.unionByName(by_content(texts.join(shared, "digest", "left_semi")))
    return found.select(
        "doc_id",
        *(F.col("others")[c].alias(c) for c in keep),
        F.col("first").alias("keep_id"),
        F.col("n").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("first")).alias("kept"),
        "digest",
    )


def by_content(texts: DataFrame) -> DataFrame:
    """The rows of digests that several contents share, each with the group of its content."""
    contents = texts.groupBy("digest", "content").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    return texts.join(contents, ["digest", "content"]).drop("content")
