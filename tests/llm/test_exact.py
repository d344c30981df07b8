"""Exact duplicates against brute force."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vecloom.llm import exact_dups
from vecloom.llm.queries import QUERIES

ROWS = [
    (5, "a  b\n"),
    (3, "a b "),
    (9, "a\tb\x0b"),
    (4, "A b "),
    (7, None),
    (6, ""),
    (8, " \r\n"),
    (2, " "),
    (1, "a b"),
    (1, "a b"),
    (None, "a b "),
    (None, "only without id"),
    (None, "only  without id"),
    (10, "no break"),
    (11, "no break"),
    (12, "long " * 60_000),
    (13, "long\t" * 60_000),
]


def brute(rows):
    contents = [re.sub(r"[\x20\x09-\x0d]+", " ", text or "") for _, text in rows]
    size = Counter(contents)
    found = []
    for (doc_id, _), content in zip(rows, contents, strict=True):
        ids = [i for (i, _), c in zip(rows, contents, strict=True) if c == content and i is not None]
        keep = min(ids, default=None)
        found.append((doc_id, keep, size[content], doc_id == keep, hashlib.sha256(content.encode()).hexdigest()))
    return sorted(found, key=str)


def answer(df):
    columns = "doc_id", "keep_id", "group_size", "kept", "sha"
    rows = df.withColumn("sha", F.sha2("content", 256)).select(*columns)
    return sorted((tuple(r) for r in rows.collect()), key=str)


@pytest.mark.parametrize(
    "digest", [exact_dups.sha256, lambda c: F.substring(F.sha2(c, 256), 1, 1), lambda c: F.lit("same")]
)
@pytest.mark.parametrize("hot", [1, 3, 10_000])
def test_groups_whatever_the_digest(docs, monkeypatch, digest, hot):
    monkeypatch.setattr(exact_dups, "HOT_GROUPS", hot)
    made = docs(ROWS).withColumn("content", exact_dups.normalised(F.col("text"))).repartition(5)
    found = exact_dups.find_copies(made, keep=("content",), digest=digest)
    assert answer(found) == brute(ROWS)


def test_hot_copies_meet_over_salts(spark):
    rows = spark.range(0, 9000, 1, 16).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hot  text")).otherwise(F.col("id").cast("string")).alias("text")
    )
    found = exact_dups.find_copies(rows)
    copies = found.where("group_size > 1").groupBy("keep_id", "group_size").agg(
        F.count(F.lit(1)), F.sum(F.col("kept").cast("int"))
    )
    assert [tuple(r) for r in copies.collect()] == [(0, 3000, 3000, 1)]
    assert found.where("kept").count() == 6001


def test_clashing_columns_and_empty_table(docs):
    names = ("digest", "content", "first", "n", "hot", "salt", "others", "rows", "contents")
    extra = docs([(1, "a"), (2, "a")]).withColumns({name: F.lit(name) for name in names})
    found = exact_dups.find_copies(extra.drop("digest").withColumn("keep_me", F.lit(1)), keep=("keep_me", "first"))
    assert sorted(r.kept for r in found.collect()) == [False, True]
    assert exact_dups.find_copies(docs([])).count() == 0


def test_native(spark, sf):
    plan = QUERIES["op11_exact_dedup"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
