"""The corpus pipeline: stages over ``documents``, each written and read again.

Every stage keeps the columns of ``documents`` (the last one gives packed pieces) and works
on all rows its predecessor kept. Repeated rows of one id are told apart by their text.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.llm import packing, pii, quality, simhash, substring
from vecloom.llm.common import bounded_batches, table
from vecloom.llm.queries import BYTE_BPE
from vecloom.session import passing_scratch, run_dir

# A document below this quality goes.
QUALITY = 0.3
# A column of a stage's own: a document's id and text as 256 bits, or all its columns.
ROW = "corpus_pipeline_row"


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that the line model rejects go. Null and empty texts have a score
    like any other; repeated rows and other columns stay. An empty table gives no rows."""
    labels = table(spark, sf_dir, "labels").where(~quality.held_out(F.col("doc_id")))
    model = quality.train(docs, labels)
    return docs.where(quality.score(model, F.col("text")) >= QUALITY)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10, with its shingles of three words and its radius of two bits: of each group
    the document with the smallest id stays.

    Null and empty texts have the fingerprint zero and are one group. A null id stays only in
    a group without others. Of rows with the smallest id and other texts the one with the
    smallest digest stays; rows that repeat id and text are one document, of which one row
    stays. An empty table gives no rows. Other columns stay as they are, and the stage adds
    none.
    """
    key = F.sha2(F.to_json(F.struct("doc_id", "text")), 256)
    marked = docs.withColumn(ROW, key)
    found = simhash.near_duplicates(marked, keep=(ROW,))
    first = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = first.groupBy("component").agg(F.min(ROW).alias(ROW)).select(ROW)
    return marked.join(chosen, ROW, "left_semi").dropDuplicates([ROW]).select(*docs.columns)


def restored(docs: DataFrame, text: Column, n_chars: Column) -> list[Column]:
    """The columns of docs out of ROW, with another text and its length."""
    fresh = {"text": text, "n_chars": n_chars}
    return [fresh.get(c, F.col(ROW)[c]).alias(c) for c in docs.columns]


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: passages of 20 words and more that start earlier are cut out.

    Texts that lose nothing stay as they are, null ones too; the others are their kept words,
    and ``n_chars`` follows. Rows of one id and text are one document: neither repeats the
    other. An empty table gives no rows, and other columns stay.
    """
    # As one column, so that no name of theirs can clash with the operator's.
    packed = docs.select("doc_id", "text", F.struct("*").alias(ROW))
    found = substring.remove_repeats(packed, keep=(ROW,))
    changed = F.col("n_removed") > 0
    length = F.when(changed, F.length("kept").cast("long")).otherwise(F.col(ROW)["n_chars"])
    text = F.when(changed, F.col("kept")).otherwise(F.col(ROW)["text"])
    return found.select(*restored(docs, text, length))


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: personal data becomes [KIND]; other texts stay as they are, null ones too,
    and so do other columns and repeated rows. An empty table gives no rows."""
    found = pii.find(docs.select("doc_id", "text", F.struct("*").alias(ROW)), keep=(ROW,))
    rows = found.select("spans", F.col("others")[ROW].alias(ROW))
    rows = rows.withColumn("marked", pii.redacted(F.col(ROW)["text"], F.col("spans")))
    length = F.when(F.size("spans") > 0, F.length("marked").cast("long")).otherwise(F.col(ROW)["n_chars"])
    return rows.select(*restored(docs, F.col("marked"), length))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: every remaining text in sequences of at most 2048 tokens. Null and empty
    texts take one token; repeated rows are packed each. An empty table gives no rows."""
    return packing.pack(docs, BYTE_BPE)


def bounded(stage: Callable) -> Callable:
    """The stage with Arrow batches of bounded size."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("quality_filter", bounded(quality_filter)),
    ("simhash_dedup", bounded(simhash_dedup)),
    ("substring_dedup", bounded(substring_dedup)),
    ("pii_redaction", bounded(pii_redaction)),
    ("best_fit_packing", bounded(best_fit_packing)),
]
# A trained model and a tokenizer have no SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = run_dir(spark, name)
        with passing_scratch(spark):
            rows = stage(spark, docs, sf_dir)
            rows.write.parquet(path)
        docs = spark.read.schema(rows.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
