"""The pipeline, stage by stage, and the registered queries."""

import duckdb
import os
import pytest
from collections import Counter
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from tests.llm import brute
from vecloom.llm import queries

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, t, "en", "s", len(t) if t else 0) for i, t in rows],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )


def test_stages_are_registered():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_filter", "simhash_dedup", "substring_dedup", "pii_redaction", "best_fit_packing",
    ]
    found = __spark_entry__.queries()
    assert found["pipeline"] is corpus_pipeline.run
    assert sorted(int(n[2:].split("_")[0]) for n in found if n.startswith("op")) == list(range(1, 14))


def test_quality_stage_keeps_clean_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = corpus_pipeline.quality_filter(spark, docs, sf)
    assert kept.columns == COLUMNS
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    good, bad = (labels.where(F.col("quality") == q) for q in (1, 0))
    assert kept.join(bad, "doc_id").count() <= 1
    assert kept.join(good, "doc_id").count() >= good.join(docs, "doc_id").count() - 1


def kept_by_groups(rows):
    return Counter(i for i, _, least in brute.simhash(rows) if i == least)


def test_simhash_stage(spark, sf):
    rows = [(3, "a b c d e f"), (1, "A b c d e f"), (1, "A b c d e f"), (2, "other words here"), (None, "z y x w"), (9, None), (8, "")]
    kept = corpus_pipeline.simhash_dedup(spark, frame(spark, rows), sf)
    assert kept.columns == COLUMNS
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 8]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = corpus_pipeline.simhash_dedup(spark, docs, sf).collect()
    rows = {r.doc_id: r for r in docs.collect()}
    assert Counter(r.doc_id for r in kept) == kept_by_groups([(r.doc_id, r.text) for r in rows.values()])
    assert all(r == rows[r.doc_id] for r in kept)


ODD = [(4, None), (3, ""), (1, "some words of a text"), (1, "some words of a text"), (None, None), (7, "x" * 200_000), (2, " \n\t ")]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_of_odd_and_of_no_rows(spark, sf, name, stage):
    """Nulls, empty and long texts, repeats, null ids, extra columns of clashing names."""
    names = ("row", "corpus_pipeline_row2", "others", "spans", "packed", "digest", "fingerprint", "component", "kept")
    odd = frame(spark, ODD).withColumns({n: F.lit(n) for n in names})
    done = stage(spark, odd, sf)
    if name == "best_fit_packing":
        assert Counter(r.doc_id for r in done.where("piece = 0").collect()) == Counter(i for i, _ in ODD)
    else:
        assert done.columns == odd.columns
        assert all(r[n] == n for r in done.collect() for n in names)
    if name in ("substring_dedup", "pii_redaction"):
        assert Counter((r.doc_id, r.text) for r in done.collect()) == Counter(ODD)
    if name == "simhash_dedup":
        assert Counter(r.doc_id for r in done.collect()) == Counter([1, 2, 7])
    assert stage(spark, odd.limit(0), sf).count() == 0


def test_substring_stage(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    done = {r.doc_id: r for r in corpus_pipeline.substring_dedup(spark, docs, sf).collect()}
    before = {r.doc_id: r for r in docs.collect()}
    assert set(done) == set(before)
    for i, _, removed, digest in brute.repeats([(r.doc_id, r.text) for r in before.values()]):
        if removed:
            assert brute.sha(done[i].text) == digest and done[i].n_chars == len(done[i].text)
        else:
            assert done[i] == before[i]


def test_redaction_stage(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    done = corpus_pipeline.pii_redaction(spark, docs, sf)
    assert done.columns == COLUMNS
    done = {r.doc_id: r for r in done.collect()}
    before = {r.doc_id: r for r in docs.collect()}
    assert set(done) == set(before)
    for i, row in before.items():
        text, at, out = row.text, 0, ""
        for start, _, kind, end in brute.personal(text):
            if start >= at:
                out += text[at:start] + f"[{kind.upper()}]"
            at = max(at, end)
        assert done[i].text == out + text[at:]
        assert not brute.personal(done[i].text)


def test_whole_pipeline(spark, sf):
    done = corpus_pipeline.run(spark, sf).toPandas()
    assert done.groupby("sequence_id").length.sum().max() <= 2048
    assert len(done) and not done.duplicated(["doc_id", "piece"]).any()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_match_their_sql(spark, sf, name):
    database = duckdb.connect()
    for file in os.listdir(sf):
        database.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{file}'")
    found = queries.QUERIES[name](spark, sf)
    wanted = database.execute(queries.ORACLE[name])
    names = [d[0] for d in wanted.description]
    assert sorted(found.columns) == sorted(names)
    assert Counter(map(tuple, found.select(*names).collect())) == Counter(wanted.fetchall())
