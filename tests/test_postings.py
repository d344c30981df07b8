"""Bucket postings: what is probed, what is read, and that the rest is exact."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import brute_force, found_ids, query_frame, unit_vectors, vector_frame
from vecloom.operators import approx, bounded, postings
from vecloom.operators.search import exact_top_k
from vecloom.operators.store import VectorTable


def clustered(count, dim, seed=0):
    """Unit vectors around a few centres."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, dim))
    rows = centres[np.arange(count) % 6] + 0.15 * rng.standard_normal((count, dim))
    return (rows / np.linalg.norm(rows, axis=1, keepdims=True)).astype("float32")


@pytest.fixture()
def path(tmp_path):
    return str(tmp_path / "postings")


def write(spark, matrix, path, tables=3, bits=4):
    corpus = vector_frame(spark, matrix).withColumnRenamed("paragraph_id", "id")
    postings.write_postings(corpus, path, matrix.shape[1], tables, bits)


def test_nearest_buckets_first():
    sides = np.random.default_rng(1).standard_normal((40, 3, 5))
    order = postings.probe_order(sides, 32)
    for row, table in itertools.product(range(40), range(3)):
        cost = [sum(sides[row, table, b] ** 2 for b in range(5) if m >> b & 1) for m in range(32)]
        assert order[row, table].tolist() == sorted(range(32), key=lambda m: (round(cost[m], 9), m))
    assert (postings.probe_order(np.zeros((1, 1, 3)), 4) == np.arange(4)).all()


def test_one_probe_is_the_own_cell(spark):
    frame = query_frame(spark, unit_vectors(20, 8))
    one = postings.probed_cells(frame, 8, 3, 4, 1).select("query_id", F.sort_array("cells").alias("c")).collect()
    own = approx.hyperplane_cells(frame, 8, 3, 4).select("query_id", F.sort_array("cells").alias("c")).collect()
    assert sorted(one) == sorted(own)


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_all_buckets_give_the_exact_rows(spark, path, limit):
    matrix = clustered(120, 8)
    write(spark, matrix, path)
    found = postings.search_postings(query_frame(spark, matrix[:5]), path, 7, 16, limit_bytes=limit)
    assert found_ids(found, 5) == brute_force(matrix[:5], matrix, 7, [f"p{i}" for i in range(120)])


def test_only_probed_folders_are_read(spark, path, monkeypatch):
    monkeypatch.setattr(postings, "BLOCK_BITS", 3)
    matrix = clustered(600, 16, seed=3)
    write(spark, matrix, path, tables=2, bits=6)
    asked = query_frame(spark, matrix[:2])
    made = postings.probed_cells(asked, 16, 2, 6, 1)
    found = postings.candidates(made, path, 6)
    vectors = postings.candidate_vectors(found, path)
    plan = vectors._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "block" in plan.split("PartitionFilters: [")[1][:60]
    assert vectors.count() == found.count() < 600
    rows = [postings.share_read(asked, path, p).first() for p in (1, 8, 64)]
    assert rows[0].n_blocks_read < rows[0].n_blocks / 2
    assert [r.n_candidates for r in rows] == sorted(r.n_candidates for r in rows)
    assert rows[-1].n_candidates == rows[-1].n_rows == 600 and rows[-1].n_blocks_read == rows[-1].n_blocks


def test_recall_grows_with_the_probes(spark, tmp_path):
    matrix = clustered(400, 16, seed=5)
    table = VectorTable.create(vector_frame(spark, matrix), str(tmp_path / "store"), 2)
    asked = query_frame(spark, matrix[::40])
    with pytest.raises(ValueError, match="not been built"):
        table.search(asked, 5, method="postings")
    table.build_postings(tables=2, bits=6)
    exact = table.search(asked, 10)
    shares = [
        approx.recall(table.search(asked, 10, method="postings", probes=p), exact).agg(F.avg("recall")).first()[0]
        for p in (1, 4, 64)
    ]
    assert shares == sorted(shares) and shares[0] > 0.1 and shares[-1] == 1.0


def test_hot_bucket_and_no_rows(spark, path, tmp_path):
    matrix = np.repeat(unit_vectors(1, 8), 50, axis=0)
    write(spark, matrix, path)
    found = postings.search_postings(query_frame(spark, matrix[:1]), path, 3, 1)
    assert found_ids(found, 1) == [["p0", "p1", "p10"]]
    assert postings.search_postings(query_frame(spark, matrix[:1]).limit(0), path, 3, 1).count() == 0


@pytest.mark.parametrize("bits, probes", [(13, 1), (4, 0), (4, 17)])
def test_bad_probes(spark, bits, probes):
    with pytest.raises(ValueError, match="between|at most"):
        postings.probed_cells(query_frame(spark, unit_vectors(1, 8)), 8, 1, bits, probes)


# --- exact search by bounds -----------------------------------------------------------


def bounded_store(spark, matrix, path, blocks, monkeypatch):
    monkeypatch.setattr(bounded, "BLOCK_ROWS", blocks)
    corpus = vector_frame(spark, matrix).withColumnRenamed("paragraph_id", "id")
    bounded.write_bounded(corpus, path, matrix[:6].astype("float64"))


@pytest.mark.parametrize("metric", ["ip", "cosine"])
@pytest.mark.parametrize("clusters", [True, False])
def test_bounds_keep_the_exact_rows(spark, path, monkeypatch, metric, clusters):
    matrix = clustered(300, 12, seed=7) if clusters else unit_vectors(300, 12)
    matrix = matrix * (1 + np.arange(300)[:, None] % 5) if metric == "ip" else matrix
    bounded_store(spark, matrix, path, 40, monkeypatch)
    read: list = []
    asked = query_frame(spark, matrix[:4])
    found = bounded.search_bounded(asked, path, 9, metric=metric, read=read)
    corpus = vector_frame(spark, matrix).withColumnRenamed("paragraph_id", "id")
    want = exact_top_k(asked, corpus, 9, metric=metric)
    assert found_ids(found, 4) == found_ids(want, 4)
    n_blocks = spark.read.parquet(f"{path}/bounds").count()
    assert n_blocks >= 300 / 40 and not set(read[0]) & set(read[1])
    if clusters and metric == "cosine":
        assert len(read[0]) + len(read[1]) < n_blocks


def test_blocks_out_of_reach_are_not_read(spark, path, monkeypatch):
    matrix = clustered(600, 16, seed=9)
    bounded_store(spark, matrix, path, 25, monkeypatch)
    read: list = []
    found = bounded.search_bounded(query_frame(spark, matrix[:1]), path, 3, read=read)
    assert found_ids(found, 1) == brute_force(matrix[:1], matrix, 3, [f"p{i}" for i in range(600)])
    n_blocks = spark.read.parquet(f"{path}/bounds").count()
    assert len(read[0]) + len(read[1]) <= n_blocks / 2


def test_bounded_search_of_few_rows_and_many_queries(spark, path, monkeypatch):
    matrix = unit_vectors(5, 8)
    corpus = vector_frame(spark, np.vstack([matrix, np.zeros((1, 8))])).withColumnRenamed("paragraph_id", "id")
    bounded.write_bounded(corpus, path, matrix[:2].astype("float64"))
    asked = query_frame(spark, matrix)
    for limit in (1 << 20, 1):
        found = bounded.search_bounded(asked, path, 50, metric="cosine", exclude_self=True, limit_bytes=limit)
        assert found.count() == 5 * 6
    assert bounded.search_bounded(asked.limit(0), path, 3).count() == 0
