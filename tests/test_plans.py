import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from registry import queries
from registry.tables import paragraphs
from tests.conftest import unit_vectors, vector_frame
from vecloom.operators import lookup
from vecloom.operators.embed import HashingEmbedder, embed_texts
from vecloom.operators.quantiles import index_quantiles
from vecloom.operators.store import VectorTable
from vecloom.plans import build, report, requests
from vecloom.session import run_dir, scratch_root, settled, spread
from vecloom.sources.tables import PARAGRAPH_SCHEMA
from vecloom.streaming.ingest import add_stream

TEXTS = [
    ("1_0", 1, "cats", "the quick brown cat sleeps"),
    ("1_1", 1, "cats", "a cat and a dog"),
    ("2_0", 2, "spark", "spark processes large data"),
    ("3_0", 3, "none", "..."),
    ("4_0", 4, "dogs", "dogs chase the quick cat"),
]


@pytest.fixture()
def texts(spark):
    return spark.createDataFrame(TEXTS, PARAGRAPH_SCHEMA)


@pytest.fixture()
def corpus(texts):
    rows = embed_texts(texts, HashingEmbedder, keep=("paragraph_id", "article_title"))
    return rows.withColumnRenamed("paragraph_id", "id")


def asked(spark, rows):
    return spark.createDataFrame(rows, "query_id string, text string, k int")


@pytest.mark.parametrize("limit_bytes", [1 << 20, 0])
def test_text_search(spark, texts, corpus, limit_bytes):
    requests_in = asked(spark, [("a", "quick cat", 2), ("b", "spark data", 1), ("c", "  ", 5),
                                ("d", "x", 0), ("e", "x", 51), ("f", "cat", 50), ("g", "dog", None)])
    answers, rejected = requests.text_search(requests_in, corpus, texts, HashingEmbedder,
                                             limit_bytes=limit_bytes)
    rows = {(r.query_id, r.rank): r for r in answers.collect()}
    assert {q for q, _ in rows} == {"a", "b", "f", "g"}
    assert rows["b", 1].doc_id == "2_0" and rows["b", 1].text == "spark processes large data"
    assert rows["b", 1].title == "spark" and rows["b", 1].query == "spark data"
    assert [q for q, _ in rows].count("a") == 2 and [q for q, _ in rows].count("f") == 5
    assert [q for q, _ in rows].count("g") == 5
    assert {r.query_id: r.error for r in rejected.collect()} == {
        "c": "Query cannot be empty", "d": "k must be between 1 and 50",
        "e": "k must be between 1 and 50"}


def test_only_blank_requests(spark, texts, corpus):
    answers, rejected = requests.text_search(asked(spark, [("a", " ", 5)]), corpus, texts, HashingEmbedder)
    assert answers.count() == 0 and rejected.count() == 1


def test_responses_are_ordered(spark, texts, corpus):
    answers, _ = requests.text_search(asked(spark, [("a", "quick cat", 3)]), corpus, texts, HashingEmbedder)
    row = requests.responses(answers).first()
    scores = [r.score for r in row.results]
    assert row.query == "quick cat" and scores == sorted(scores, reverse=True) and len(scores) == 3


def test_similar_documents(spark, texts, corpus):
    wanted = spark.createDataFrame([("1_0",)] * 50 + [("4_0",), ("nope",)], "id string")
    answers, unknown = requests.similar_documents(wanted, corpus, texts, k=2)
    rows = answers.orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank) for r in rows] == [("1_0", 1), ("1_0", 2), ("4_0", 1), ("4_0", 2)]
    assert rows[0].doc_id == "4_0" and rows[0].query == "similar to 1_0"
    assert all(r.doc_id != r.query_id for r in rows)
    assert [r.error for r in unknown.collect()] == ["id 'nope' not found"]


@pytest.mark.parametrize("k", [0, 51])
def test_similar_k_bounds(spark, texts, corpus, k):
    with pytest.raises(ValueError, match="k must be"):
        requests.similar_documents(spark.createDataFrame([("1_0",)], "id string"), corpus, texts, k=k)


def test_embed_requests(spark):
    df = spark.createDataFrame([("a", "some words"), ("b", "\t")], "id string, text string")
    good, bad = requests.embed_requests(df, HashingEmbedder, keep=("id",))
    row = good.first()
    assert (row.id, row.text, row.dims, len(row.embedding)) == ("a", "some words", 64, 64)
    assert [(r.id, r.error) for r in bad.collect()] == [("b", "Text cannot be empty")]


def test_hydrate_keeps_hits_without_text(spark, texts):
    hits = spark.createDataFrame([("q", "1_0"), ("q", "gone"), ("r", "1_0")], "query_id string, id string")
    out = {(r.query_id, r.id): r.text for r in lookup.hydrate(hits, texts).collect()}
    assert out == {("q", "1_0"): TEXTS[0][3], ("r", "1_0"): TEXTS[0][3], ("q", "gone"): None}


def test_hydrate_runs_the_search_once(spark, texts, corpus):
    calls = spark.sparkContext.accumulator(0)

    def count(batches):
        calls.add(1)
        yield from batches

    hits = corpus.select("id").coalesce(1).mapInArrow(count, "id string")
    assert lookup.hydrate(hits, texts).count() == 5
    assert calls.value == 1


def test_texts_of_other_shards_are_not_read(spark, texts, tmp_path):
    path = str(tmp_path / "texts")
    rows = texts.select("paragraph_id", F.substring_index("paragraph_id", "_", 1).cast("long").alias("article_id"), "text")
    lookup.write_texts(rows, path, 4)
    schema = "query_id string, id string, article_id long"
    hits = [("q", "1_0", 1), ("q", "1_99", 1), ("r", "1_0", 1), ("r", "x", None), (None, None, 1)]
    out = lookup.hydrate_by_shard(spark.createDataFrame(hits, schema), path, 4)
    filters = out._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1:]
    assert any("shard_id" in f.split("]")[0] for f in filters)
    assert out.columns == ["query_id", "id", "article_id", "text"]
    found = {(r.query_id, r.id): r.text for r in out.collect()}
    assert found == {
        ("q", "1_0"): TEXTS[0][3], ("q", "1_99"): None, ("r", "1_0"): TEXTS[0][3], ("r", "x"): None, (None, None): None
    }
    assert lookup.hydrate_by_shard(spark.createDataFrame([], schema), path, 4).count() == 0


def test_few_hits_are_broadcast_to_the_paragraphs(spark, sf):
    rows = paragraphs(spark, sf)
    hits = rows.select(F.col("paragraph_id").alias("id")).orderBy("id").limit(20)
    plan = lookup.hydrate(hits, spark.read.parquet(settled_path(spark, rows)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def settled_path(spark, rows):
    path = run_dir(spark, "paragraphs")
    rows.write.parquet(path)
    return path


def test_few_requests_are_broadcast_to_the_table(spark, texts):
    wanted = spark.createDataFrame([("1_0",), ("x",)], "paragraph_id string")
    table = settled(texts, "texts")
    for part in lookup.known_and_unknown(wanted, table, "paragraph_id"):
        text = part._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_known_and_unknown(spark, texts):
    wanted = spark.createDataFrame([("1_0",), ("1_0",), ("x",), (None,)], "paragraph_id string")
    known, unknown = lookup.known_and_unknown(wanted, texts, "paragraph_id")
    assert [r.paragraph_id for r in known.collect()] == ["1_0"]
    assert {r.paragraph_id for r in unknown.collect()} == {"x", None}


# --- quantiles and reports ------------------------------------------------------------


def by_rule(values, share):
    return sorted(values)[int(len(values) * share)]


@pytest.mark.parametrize("n", [1, 2, 10, 20, 1000])
def test_index_quantiles_equal_the_rule(spark, n):
    values = [math.sin(i) * 100 for i in range(n)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    r = report.latency_stats(df, "v").first()
    assert (r.n, r.p50, r.p95) == (n, by_rule(values, 0.5), by_rule(values, 0.95))
    assert r.mean == pytest.approx(sum(values) / n)


def test_p95_of_ten_is_the_maximum(spark):
    df = spark.range(10).select(F.col("id").cast("double").alias("v"))
    r = report.latency_stats(df, "v").first()
    assert (r.p50, r.p95) == (5.0, 9.0)


def test_no_durations(spark):
    assert report.latency_stats(spark.createDataFrame([], "v double"), "v").count() == 0


def test_hot_group_and_hot_value(spark):
    """One group holds nearly all rows and half of them share a value."""
    df = spark.range(60_000).select(
        F.when(F.col("id") % 1000 == 0, "rare").otherwise("hot").alias("g"),
        F.when(F.col("id") % 2 == 0, 5.0).otherwise(F.pmod(F.xxhash64("id"), F.lit(10_000)) / 1000.0).alias("v"),
    )
    got = {r.g: r for r in index_quantiles(df, "v", {"a": 0.5, "b": 0.95, "c": 0.0, "d": 0.999}, "g").collect()}
    rows = df.collect()
    for g in ("rare", "hot"):
        values = [r.v for r in rows if r.g == g]
        assert (got[g].a, got[g].b, got[g].c, got[g].d) == tuple(
            by_rule(values, s) for s in (0.5, 0.95, 0.0, 0.999))


def test_null_group_and_null_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0), ("a", None), ("b", None)],
                               "g string, v double")
    rows = {r.g: (r.n, r.p50) for r in report.latency_stats(df, "v", "g").collect()}
    assert rows == {None: (2, 3.0), "a": (1, 2.0)}


@pytest.mark.parametrize("margin", [0.0, -0.02, 0.3])
def test_quantiles_do_not_depend_on_the_sketch(spark, monkeypatch, margin):
    """Brackets that miss the position still give the exact element."""
    monkeypatch.setattr("vecloom.operators.quantiles.MARGIN", margin)
    monkeypatch.setattr("vecloom.operators.quantiles.ACCURACY", 3)
    df = spark.range(3000).select(F.pmod(F.xxhash64("id"), F.lit(997)).cast("double").alias("v"))
    values = [r.v for r in df.collect()]
    r = index_quantiles(df, "v", {"x": 0.5, "y": 0.95, "z": 0.1}).first()
    assert (r.x, r.y, r.z) == tuple(by_rule(values, s) for s in (0.5, 0.95, 0.1))


def test_throughput_without_time(spark):
    df = spark.createDataFrame([(10, 2.0), (10, 0.0)], "n long, s double")
    assert [r.t for r in df.select(report.throughput("n", "s").alias("t")).collect()] == [5.0, 0.0]


def test_worker_scaling(spark):
    runs = spark.createDataFrame(
        [(1, 20000, 267.0), (2, 20000, 160.6), (4, 20000, 154.7), (8, 20000, 166.8)],
        "worker_count int, num_rows long, duration_s double")
    runs = runs.withColumn("stage", F.lit("embed"))
    rows = report.worker_scaling(runs, "stage").orderBy("worker_count").collect()
    assert [r.is_peak for r in rows] == [False, False, True, False]
    assert rows[0].speedup == 1.0 and rows[2].speedup == pytest.approx(267.0 / 154.7)


def test_metrics_append(spark, tmp_path):
    path = str(tmp_path / "metrics")
    for workers in (1, 2):
        report.append_metrics(
            report.metric_line(spark, "embed", 1.5, throughput=3.0, throughput_unit="rows/s",
                               worker_count=workers, extra={"limit": 0}), path)
    rows = report.read_metrics(spark, path).orderBy("worker_count").collect()
    assert [(r.stage, r.worker_count, r.extra) for r in rows] == [
        ("embed", 1, {"limit": "0"}), ("embed", 2, {"limit": "0"})]


def test_shard_stats_and_size(spark, tmp_path):
    path = str(tmp_path / "s")
    table = VectorTable.create(vector_frame(spark, unit_vectors(10, 4)), path, 2)
    rows = {r.shard_id: r for r in report.shard_stats(table.vectors()).collect()}
    assert rows[0].num_vectors == 6 and rows[0].num_articles == 3 and rows[0].raw_bytes == 6 * 16
    size = report.stored_size(spark, path).first()
    assert size.n_files >= 2 and size.total_bytes > 0


def test_longest(spark):
    df = spark.createDataFrame([("a", "xx"), ("b", "xxx"), ("c", "xx")], "id string, t string")
    assert [tuple(r) for r in report.longest(df, "t", "id", 2).collect()] == [("b", 3), ("a", 2)]


# --- build, timed search, stream ------------------------------------------------------


def test_build_store_and_timed_search(spark, sf, tmp_path):
    path = str(tmp_path / "built")
    rows = paragraphs(spark, sf)
    table = build.build_store(rows, path, num_shards=4)
    assert table.vectors().count() == rows.count()
    assert spark.read.parquet(f"{path}/sample_queries").count() == 10
    run = spark.read.json(f"{path}/report").first()
    assert run.num_paragraphs == rows.count() and len(run.shard_stats) == 4
    line = build.timed_search(spark, path, k=5).first()
    assert line.stage == "query_sharded" and line.extra["num_queries"] == "10"
    stages = {r.stage for r in report.read_metrics(spark, f"{path}/metrics").collect()}
    assert stages == {"embed", "index_build", "query_sharded"}


def test_build_with_limit_and_one_shard(spark, sf, tmp_path):
    path = str(tmp_path / "built")
    table = build.build_store(paragraphs(spark, sf), path, limit=25)
    assert table.vectors().count() == 25
    assert build.timed_search(spark, path).first().stage == "query_centralized"


@pytest.mark.parametrize("options", [{"num_shards": 0}, {"embedder": "nope"}])
def test_bad_build_settings_fail_before_any_job(spark, sf, tmp_path, options):
    with pytest.raises(ValueError):
        build.build_store(paragraphs(spark, sf), str(tmp_path / "x"), **options)
    assert not (tmp_path / "x").exists()


def test_stream_adds_batches_and_can_resume(spark, tmp_path, texts):
    arriving = str(tmp_path / "arriving")
    table = VectorTable.create(
        embed_texts(texts, HashingEmbedder, keep=("paragraph_id", "article_id", "article_title")),
        str(tmp_path / "store"), 2)
    stream = lambda: add_stream(
        spark.readStream.schema(PARAGRAPH_SCHEMA).parquet(arriving), table, HashingEmbedder,
        str(tmp_path / "progress")).awaitTermination()
    texts.limit(0).write.parquet(arriving)
    changed = spark.createDataFrame([("1_0", 1, "new title", "changed"), ("9_0", 9, "nine", "added")],
                                    PARAGRAPH_SCHEMA)
    changed.write.mode("append").parquet(arriving)
    stream()
    stream()
    spark.createDataFrame([("9_0", 9, "nine again", "x")], PARAGRAPH_SCHEMA).write.mode("append").parquet(arriving)
    stream()
    got = {r.paragraph_id: r.article_title for r in table.vectors().collect()}
    assert got == {"1_0": "new title", "1_1": "cats", "2_0": "spark", "3_0": "none", "4_0": "dogs",
                   "9_0": "nine again"}


# --- session --------------------------------------------------------------------------


def test_run_folders_differ_and_share_the_root(spark):
    one, other = run_dir(spark, "x"), run_dir(spark, "x")
    assert one != other and one.startswith(scratch_root(spark))


def test_settled_is_a_scan_with_the_same_rows(spark):
    rows = settled(spark.range(5), "five")
    assert "FileScan" in rows._jdf.queryExecution().executedPlan().toString()
    assert rows.count() == 5


def test_spread_leaves_many_files_alone(spark, tmp_path):
    def parts(rows):
        return rows.select(F.spark_partition_id().alias("p")).distinct().count()

    path = str(tmp_path / "rows")
    spark.range(0, 1000, 1, 64).write.parquet(path)
    many = spark.read.parquet(path)
    assert spread(many, "id") is many
    one = str(tmp_path / "one")
    spark.range(0, 1000, 1, 1).write.parquet(one)
    assert parts(spread(spark.read.parquet(one), "id")) > 1
    assert parts(spread(many, "id", tasks=3)) <= 3


# --- nothing is lost or mixed up --------------------------------------------------------


def test_requests_that_share_an_id_are_answered_each(spark, texts, corpus):
    rows = [("a", "quick cat", 2), ("a", "spark data", 1), (None, "dog", 1), (None, " ", 1), ("a", "quick cat", 2)]
    answers, rejected = requests.text_search(asked(spark, rows), corpus, texts, HashingEmbedder)
    found = answers.collect()
    assert len(found) == 6 and rejected.count() == 1
    assert len({(r.request_no, r["rank"]) for r in found}) == 6
    assert {r.doc_id for r in found if r.query == "spark data"} == {"2_0"}
    assert [r.query_id for r in found if r.query == "dog"] == [None]
    grouped = requests.responses(answers).collect()
    assert sorted((r.query, len(r.results)) for r in grouped) == [
        ("dog", 1), ("quick cat", 2), ("quick cat", 2), ("spark data", 1)]


def test_null_ids_are_not_found(spark):
    table = spark.createDataFrame([(1, "x"), (None, "y")], "id bigint, name string")
    wanted = spark.createDataFrame([(1,), (None,), (None,), (999,)], "id bigint")
    known, unknown = lookup.known_and_unknown(wanted, table, "id")
    assert [r.name for r in known.collect()] == ["x"]
    assert {(r.id, r.error) for r in unknown.collect()} == {
        (None, "id 'null' not found"), (999, "id '999' not found")}


def test_streams_and_batches_keep_their_rows(spark, tmp_path, texts):
    table = VectorTable.create(
        embed_texts(texts, HashingEmbedder, keep=("paragraph_id", "article_id", "article_title")),
        str(tmp_path / "store"), 2)
    def new(name):
        return spark.createDataFrame([(f"{name}_{i}", i, name, "words") for i in range(3)], PARAGRAPH_SCHEMA)

    table.add_batch(embed_texts(new("batch"), HashingEmbedder, keep=("paragraph_id", "article_id", "article_title")))
    for name in ("first", "second"):
        new(name).write.parquet(str(tmp_path / name))
        for _ in range(2):  # a resumed stream adds nothing twice
            stream = spark.readStream.schema(PARAGRAPH_SCHEMA).parquet(str(tmp_path / name))
            add_stream(stream, table, HashingEmbedder, str(tmp_path / f"progress {name}")).awaitTermination()
    got = [r.paragraph_id for r in table.vectors().collect()]
    assert len(got) == len(TEXTS) + 9 and len(set(got)) == len(got)


def test_a_batch_run_again_replaces_its_own(spark, tmp_path):
    table = VectorTable.create(vector_frame(spark, unit_vectors(4, 4)), str(tmp_path), 2)
    table.add_batch(vector_frame(spark, unit_vectors(2, 4), "a"), writer="w", epoch=0)
    table.add_batch(vector_frame(spark, unit_vectors(2, 4), "b"))
    table.add_batch(vector_frame(spark, unit_vectors(1, 4), "c"), writer="w", epoch=0)
    assert sorted(r.paragraph_id for r in table.vectors().collect()) == ["b0", "b1", "c0", "p0", "p1", "p2", "p3"]
    for number in (0, 1):
        with pytest.raises(ValueError, match="another writer"):
            table.add_batch(vector_frame(spark, unit_vectors(1, 4), "d"), batch_no=number)


def test_a_batch_is_seen_once_it_is_logged(spark, tmp_path):
    table = VectorTable.create(vector_frame(spark, unit_vectors(4, 4)), str(tmp_path), 2)
    table._write(vector_frame(spark, unit_vectors(3, 4), "half"), 1)
    assert table.vectors().count() == 4
    table.add_batch(vector_frame(spark, unit_vectors(1, 4), "whole"))
    assert sorted(r.paragraph_id for r in table.vectors().collect())[-1] == "whole0"
    assert table.vectors().count() == 5


def test_a_new_store_has_one_row_per_id(spark, tmp_path):
    twice = vector_frame(spark, unit_vectors(4, 4)).unionAll(vector_frame(spark, unit_vectors(2, 4, seed=3)))
    table = VectorTable.create(twice, str(tmp_path / "a"), 2)
    assert table.vectors().count() == 4
    rows = spark.createDataFrame([*TEXTS, ("1_0", 1, "cats", "the second text")], PARAGRAPH_SCHEMA)
    assert build.build_store(rows, str(tmp_path / "b"), num_shards=2).vectors().count() == len(TEXTS)


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), float("-inf")])
def test_non_finite_elements_are_refused(spark, tmp_path, bad):
    rows = vector_frame(spark, np.array([[0.5, bad], [1.0, 0.0]]))
    with pytest.raises(Exception, match="non-finite"):
        VectorTable.create(rows, str(tmp_path), 1)


def test_sample_queries_read_one_shard(spark, tmp_path):
    table = VectorTable.create(vector_frame(spark, unit_vectors(40, 4)), str(tmp_path), 4)
    plan = table.sample_queries(3)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "embedding" in line)
    assert "(shard_id#" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_search_metric_has_quantiles_and_backend(spark, tmp_path, texts):
    build.build_store(texts, str(tmp_path), num_shards=2)
    line = build.timed_search(spark, str(tmp_path), 3, rounds=3).first()
    assert line.extra["backend"] == "flat" and line.extra["rounds"] == "3"
    assert 0 < float(line.extra["p50_s"]) <= float(line.extra["p95_s"])
    made = spark.read.json(str(tmp_path / "report")).first()
    assert made.num_sample_queries > 0 and made.backends == "flat"
    assert all(s.stored_bytes > 0 and s.num_vectors > 0 for s in made.shard_stats)


def test_unknown_documents_need_no_search(spark, sf, monkeypatch):
    """The ids that are not there are found from the ids alone."""
    def refused(*_, **__):
        raise AssertionError("searched or embedded")

    known = spark.createDataFrame([("a",), ("b",)], "id string")
    wanted = spark.createDataFrame([("b",), ("c",), ("c",), (None,)], "id string")
    rows = requests.unknown_documents(wanted, known).collect()
    assert sorted((r.id or "", r.error) for r in rows) == [("", "id 'null' not found"), ("c", "id 'c' not found")]
    monkeypatch.setattr(requests, "exact_top_k", refused)
    monkeypatch.setattr(queries, "embed_texts", refused)
    assert queries.f9_unknown(spark, sf).count() > 0


def test_stream_of_distinct_ids_moves_no_vectors(spark, monkeypatch):
    """Only ids are compared where none repeats; repeats are still settled."""
    def refused(*_):
        raise AssertionError("texts or vectors moved")

    rows = [(f"{n}_0", n, "t", f"word{n}") for n in range(6)]
    arriving = run_dir(spark, "arriving")
    spark.createDataFrame(rows, PARAGRAPH_SCHEMA).write.parquet(arriving)
    target = VectorTable.create(vector_frame(spark, unit_vectors(3, 64)), run_dir(spark, "store"), 2)
    with monkeypatch.context() as patch:
        patch.setattr("vecloom.operators.store.newest", refused)
        stream = spark.readStream.schema(PARAGRAPH_SCHEMA).parquet(arriving)
        add_stream(stream, target, HashingEmbedder, run_dir(spark, "progress")).awaitTermination()
    assert target.vectors().count() == 9
    spark.createDataFrame([rows[0], rows[0]], PARAGRAPH_SCHEMA).write.mode("append").parquet(arriving)
    stream = spark.readStream.schema(PARAGRAPH_SCHEMA).parquet(arriving)
    add_stream(stream, target, HashingEmbedder, run_dir(spark, "progress")).awaitTermination()
    assert target.vectors().count() == 9


def _streamed(spark, target, rows):
    """Adds the rows as a stream of one micro-batch."""
    arriving = run_dir(spark, "arriving")
    spark.createDataFrame(rows, PARAGRAPH_SCHEMA).write.parquet(arriving)
    stream = spark.readStream.schema(PARAGRAPH_SCHEMA).parquet(arriving)
    add_stream(stream, target, HashingEmbedder, run_dir(spark, "progress")).awaitTermination()


def _kept(spark):
    return spark.sparkContext._jsc.getPersistentRDDs().size()


def test_streams_at_the_same_time_compare_ids_that_were_read_once(spark, monkeypatch):
    """What a micro-batch replaces, and what another writer's batch shares with it, is found
    without its own folder being read; repeats and nulls are as they were."""
    target = VectorTable.create(vector_frame(spark, unit_vectors(3, 64), title="old {}"), run_dir(spark, "store"), 2)
    rows = [("p0", 0, "new", "a b"), ("p1", 0, "new", None), ("s", 9, "new", "e"), ("n0", 7, None, "c"), ("n0", 7, None, "d")]
    read, write, before, busy = [], VectorTable._write, _kept(spark), []
    files = VectorTable._files

    def meanwhile(self, vectors, number, compact=True):
        if self is target and not busy:
            busy.append(number)
            kind = vectors.select("paragraph_id", "article_id", "article_title", "embedding").schema
            other = spark.createDataFrame([(i, n, "other", [1.0] * 64) for i, n in (("s", 9), ("p2", 1))], kind)
            VectorTable.load(spark, target.path).add_batch(other, writer="other")
        write(self, vectors, number, compact)

    def noted(self, writes):
        writes = list(writes)
        if self is target:
            read.extend(writes)
        return files(self, writes)

    with monkeypatch.context() as patch:
        patch.setattr(VectorTable, "_write", meanwhile)
        patch.setattr(VectorTable, "_files", noted)
        _streamed(spark, target, rows)
    assert busy and busy[0] not in read and set(read) == {0, 2}
    assert _kept(spark) == before
    titles = {r.paragraph_id: r.article_title for r in target.vectors().collect()}
    assert titles == {"p0": "new", "p1": "new", "p2": "other", "n0": None, "s": "new"}
    assert target.vectors().count() == 5
    streamed = target.vectors().where("article_title = 'new' OR article_id = 7")
    made = {r.paragraph_id: list(r.embedding) for r in streamed.collect()}
    texts = [("n0", "d"), ("p0", "a b"), ("p1", ""), ("s", "e")]
    assert made == {i: HashingEmbedder().embed([t])[0].tolist() for i, t in texts}
    with pytest.raises(Exception, match="paragraph_id is null"):
        _streamed(spark, target, [(None, 1, "t", "x"), (None, 1, "t", "x"), ("q", 1, "t", "x")])
    assert _kept(spark) == before and target.vectors().count() == 5


def test_streams_into_batches_read_a_folder_for_later_ones_only(spark, sf, monkeypatch):
    """Of two streams into a store of two batches the first one's folder is read for the second
    one's comparison and for the result, the second one's for the result alone."""
    files, read = VectorTable._files, []

    def noted(self, writes):
        writes = list(writes)
        read.append(writes)
        return files(self, writes)

    monkeypatch.setattr(VectorTable, "_files", noted)
    rows = queries.j1_stream_into_batches(spark, sf)
    assert [sum(n in writes for writes in read) for n in (2, 3)] == [2, 1]
    assert rows.count() == rows.select("paragraph_id").distinct().count()


def test_arriving_files_are_not_gathered_in_a_few_tasks(spark, sf, monkeypatch):
    frame = type(spark.range(0))
    real, dealt = frame.repartition, []
    monkeypatch.setattr(frame, "repartition", lambda self, n, *by: (dealt.append(n), real(self, n, *by))[1])
    queries.j1_two_streams(spark, sf)
    assert 3 not in dealt


@pytest.mark.parametrize("blocks", (1, 3))
def test_requests_are_searched_for_their_own_count(spark, texts, corpus, monkeypatch, blocks):
    """A search hands over no more rows than its request wants, and the answers are those that
    each request gets alone."""
    rows = [("a", "quick cat", 2), ("b", "spark data", 1), ("c", "dog", 3), ("d", "a cat", 5)]
    alone = []
    for row in rows:
        answers, _ = requests.text_search(asked(spark, [row]), corpus, texts, HashingEmbedder)
        alone += [(r.query_id, r.rank, r.doc_id, r.score) for r in answers.collect()]
    found = []
    search = requests.exact_top_k
    monkeypatch.setattr(requests, "exact_top_k", lambda *a, **b: (found.append(search(*a, **b)), found[0])[1])
    monkeypatch.setattr("vecloom.operators.search.block_count", lambda *size: blocks)
    together, _ = requests.text_search(asked(spark, rows), corpus.coalesce(1), texts, HashingEmbedder)
    assert sorted((r.query_id, r.rank, r.doc_id, r.score) for r in together.collect()) == sorted(alone)
    if blocks == 1:
        # One task scanned the corpus.
        assert found[0].count() == 2 + 1 + 3 + 5
