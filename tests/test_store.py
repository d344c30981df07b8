import glob
import os
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import brute_force, found_ids, query_frame, unit_vectors, vector_frame
from vecloom.operators import store as st
from vecloom.operators.commits import CommitLog
from vecloom.operators.search import exact_top_k, packed
from vecloom.operators.store import VectorTable


@pytest.fixture()
def path(tmp_path):
    return str(tmp_path / "store")


def test_save_load_search(spark, path):
    vectors = unit_vectors(10, 12)
    VectorTable.create(vector_frame(spark, vectors), path, 3)
    loaded = VectorTable.load(spark, path)
    assert loaded.dim == loaded.check_dims() == 12 and loaded.num_shards == 3
    top = loaded.search(query_frame(spark, vectors[3:4]), 1).first()
    assert top.id == "p3" and top.article_title == "Article 3"


def test_written_rows_read_back_equal(spark, path):
    df = vector_frame(spark, unit_vectors(25, 6))
    back = VectorTable.create(df, path, 4).vectors()
    assert sorted(back.select(df.columns).collect()) == sorted(df.collect())
    assert all(r.shard_id == r.article_id % 4 for r in back.collect())


def test_folders_follow_partition_names(spark, path):
    VectorTable.create(vector_frame(spark, unit_vectors(24, 4)), path, 3)
    folders = {f.split("/")[-1] for f in glob.glob(f"{path}/embeddings/batch_no=0/shard_id=*")}
    assert folders == {"shard_id=0", "shard_id=1", "shard_id=2"}


def test_article_stays_in_one_shard(spark, path):
    table = VectorTable.create(vector_frame(spark, unit_vectors(40, 4)), path, 4)
    per_article = table.vectors().groupBy("article_id").agg(F.countDistinct("shard_id").alias("n"))
    assert per_article.where("n <> 1").count() == 0


def test_one_shard_is_pruned(spark, path):
    table = VectorTable.create(vector_frame(spark, unit_vectors(40, 4)), path, 4)
    shard = table.shard(2)
    assert {r.shard_id for r in shard.collect()} == {2}
    assert "(shard_id" in shard._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1]


def test_shard_without_data(spark, path):
    table = VectorTable.create(vector_frame(spark, unit_vectors(4, 4)), path, 11)
    assert {r.shard_id for r in table.shards().collect()} == {0, 1}
    assert {r.shard_id for r in table.empty_shards().collect()} == set(range(2, 11))
    assert table.shard(10).count() == 0


def test_loading_keeps_the_sharding_with_empty_shards(spark, path):
    VectorTable.create(vector_frame(spark, unit_vectors(4, 4)), path, 11)
    loaded = VectorTable.load(spark, path)
    loaded.add_batch(spark.createDataFrame([("z", 10, "t", [1.0, 0.0, 0.0, 0.0])],
                     "paragraph_id string, article_id long, article_title string, embedding array<float>"))
    assert loaded.num_shards == 11 and {r.shard_id for r in loaded.shards().collect()} == {0, 1, 10}


def test_a_batch_of_another_dimension_is_refused(spark, path):
    table = VectorTable.create(vector_frame(spark, unit_vectors(4, 4)), path)
    with pytest.raises(Exception, match="4 dimensions"):
        table.add_batch(vector_frame(spark, unit_vectors(1, 5)))


def test_repeats_within_a_batch_leave_one_row(spark, path):
    table = VectorTable.create(vector_frame(spark, unit_vectors(2, 4)), path)
    one = vector_frame(spark, unit_vectors(1, 4, seed=5), title="x {}")
    table.add_batch(one.unionByName(one))
    assert titles(table) == {"p0": "x 0", "p1": "Article 1"} and table.vectors().count() == 2


def test_loading_nothing_is_an_error(spark, path):
    with pytest.raises(ValueError, match="no store"):
        VectorTable.load(spark, path)


def test_no_store_is_an_error(spark, path):
    with pytest.raises(ValueError, match="no shards"):
        VectorTable(spark, path, 2).shards()


def test_uniting_shards_gives_the_whole(spark, path):
    table = VectorTable.create(vector_frame(spark, unit_vectors(30, 4)), path, 4)
    whole = st.unite([table.shard(n) for n in range(4)])
    assert whole.count() == 30 == sum(table.shard(n).count() for n in range(4))


@pytest.mark.parametrize("method", ["exact", "sharded"])
def test_methods_equal_brute_force(spark, path, method):
    vectors, queries = unit_vectors(60, 8, seed=1), unit_vectors(4, 8, seed=2)
    table = VectorTable.create(vector_frame(spark, vectors), path, 4)
    out = table.search(query_frame(spark, queries), 7, method=method)
    assert found_ids(out, 4) == brute_force(queries, vectors, 7, [f"p{i}" for i in range(60)])


def test_approximate_methods(spark, path):
    vectors = unit_vectors(80, 8, seed=3)
    table = VectorTable.create(vector_frame(spark, vectors), path, 2)
    queries = query_frame(spark, vectors[:6])
    with pytest.raises(ValueError, match="not been built"):
        table.search(queries, 3, method="ivf")
    table.build_ivf(5).build_lsh(tables=3, bits=2)
    exact = found_ids(table.search(queries, 3), 6)
    assert found_ids(table.search(queries, 3, method="ivf", probes=5), 6) == exact
    assert all(row[0] == f"p{i}" for i, row in enumerate(found_ids(table.search(queries, 3, method="lsh"), 6)))
    table.add_batch(vector_frame(spark, unit_vectors(2, 8), prefix="new"))
    with pytest.raises(ValueError, match="older than the store"):
        table.search(queries, 3, method="lsh")


@pytest.mark.parametrize("method", ["exact", "sharded"])
def test_flat_index_gives_the_same_rows_and_is_dropped_when_stale(spark, path, method):
    vectors = unit_vectors(50, 8, seed=4)
    table = VectorTable.create(vector_frame(spark, vectors), path, 4)
    queries = query_frame(spark, vectors[:5])
    columns = ("query_id", "rank", "id", "article_id", "article_title", "score")
    before = sorted(table.search(queries, 6, method=method).select(*columns).collect())
    table.build_flat()
    out = table.search(queries, 6, method=method)
    assert "embedding:binary" in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(out.select(*columns).collect()) == before
    table.add_batch(vector_frame(spark, unit_vectors(2, 8, seed=5), prefix="new"), batch_no=1)
    assert "embedding:binary" not in table.search(queries, 6, method=method)._jdf.queryExecution().executedPlan().toString()
    table.build_flat()
    table.add_batch(vector_frame(spark, unit_vectors(2, 8, seed=6), prefix="new"), batch_no=1)
    assert "embedding:binary" not in table.search(queries, 6, method=method)._jdf.queryExecution().executedPlan().toString()


def test_packed_queries_and_corpus(spark, path):
    vectors = unit_vectors(40, 8, seed=4)
    corpus = vector_frame(spark, vectors).withColumnRenamed("paragraph_id", "id")
    for limit in (1 << 20, 0):
        out = exact_top_k(packed(query_frame(spark, vectors[:4])), packed(corpus), 5, limit_bytes=limit)
        assert found_ids(out, 4) == brute_force(vectors[:4], vectors, 5, [f"p{i}" for i in range(40)])


def test_a_folder_holds_one_store(spark, path):
    VectorTable.create(vector_frame(spark, unit_vectors(4, 4)), path, 2)
    with pytest.raises(ValueError, match="already"):
        VectorTable.create(vector_frame(spark, unit_vectors(4, 4)), path, 3)


def test_unprobed_cells_are_not_read(spark, path):
    vectors = unit_vectors(60, 8, seed=3)
    table = VectorTable.create(vector_frame(spark, vectors), path, 1).build_ivf(6)
    out = table.search(query_frame(spark, vectors[:1]), 3, method="ivf", probes=1)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(cell" in plan or "PartitionFilters: [isnotnull(cell" in plan


def test_unknown_method(spark, path):
    table = VectorTable.create(vector_frame(spark, unit_vectors(4, 4)), path)
    with pytest.raises(ValueError, match="unknown search method"):
        table.search(query_frame(spark, unit_vectors(1, 4)), 1, method="magic")


def test_sample_queries_come_from_the_lowest_shard(spark, path):
    table = VectorTable.create(vector_frame(spark, unit_vectors(40, 4)), path, 4)
    expected = sorted(f"p{i}" for i in range(40) if (i // 2) % 4 == 0)[:5]
    assert [r.paragraph_id for r in table.sample_queries(5).collect()] == expected


# --- checks ---------------------------------------------------------------------------


def test_uneven_batch_arrays_fail(spark):
    df = spark.sql("select array('a','b') i, array(array(1f), array(2f)) v, array(map('k','v')) m")
    with pytest.raises(Exception, match="same length"):
        df.select(st.zip_batch("i", "v", "m")).collect()
    even = spark.sql("select array('a') i, array(array(1f)) v, array(map('k','v')) m")
    assert len(even.select(st.zip_batch("i", "v", "m").alias("z")).first().z) == 1


@pytest.mark.parametrize(
    "row,message",
    [
        ((None, 1, "t", [1.0, 2.0]), "paragraph_id is null"),
        (("a", 1, "t", None), "embedding is null"),
        (("a", 1, "t", [1.0, None]), "null or non-finite element"),
        (("a", 1, "t", [1.0]), "2 dimensions"),
        (("a", None, "t", [1.0, 2.0]), "article_id is null"),
    ],
)
def test_bad_rows_fail_the_write(spark, path, row, message):
    schema = "paragraph_id string, article_id long, article_title string, embedding array<float>"
    with pytest.raises(Exception, match=message):
        VectorTable.create(spark.createDataFrame([row], schema), path, 2, dim=2)


def test_uneven_dimensions_are_reported(spark, path):
    df = vector_frame(spark, unit_vectors(2, 4)).unionByName(vector_frame(spark, unit_vectors(2, 5), "x"))
    with pytest.raises(ValueError, match="between 4 and 5"):
        VectorTable.create(df, path).check_dims()


def test_collisions_are_refused(spark):
    names = spark.createDataFrame([(f"{i}_0",) for i in range(40)] * 3, "paragraph_id string")
    assert st.id_collisions(names).count() == 0
    st.refuse_collisions(names)
    assert st.id_collisions(names, bits=4).count() > 0
    with pytest.raises(ValueError, match="collision"):
        st.refuse_collisions(names, bits=4)


def test_repeating_one_id_is_no_collision(spark):
    names = spark.createDataFrame([("same",)] * 100, "paragraph_id string")
    assert st.id_collisions(names, bits=4).count() == 0


def test_id_map(spark, path, tmp_path):
    table = VectorTable.create(vector_frame(spark, unit_vectors(5, 4)), path)
    rows = table.write_id_map(str(tmp_path / "ids")).orderBy("paragraph_id").collect()
    assert rows[3].metadata_json == '{"article_id":1,"article_title":"Article 3"}'
    assert len({r.vector_id for r in rows}) == 5


# --- batches --------------------------------------------------------------------------


def titles(table):
    return {r.paragraph_id: r.article_title for r in table.vectors().collect()}


def test_adding_replaces_and_appends(spark, path):
    table = VectorTable.create(vector_frame(spark, unit_vectors(6, 4)), path, 2)
    table.add_batch(vector_frame(spark, unit_vectors(3, 4, seed=9), title="second {}"))
    table.add_batch(vector_frame(spark, unit_vectors(1, 4, seed=8), title="third {}"))
    table.add_batch(vector_frame(spark, unit_vectors(2, 4, seed=7), prefix="n", title="new {}"))
    assert titles(table) == {
        "p0": "third 0", "p1": "second 1", "p2": "second 2", "p3": "Article 3",
        "p4": "Article 4", "p5": "Article 5", "n0": "new 0", "n1": "new 1",
    }
    assert table.stored().count() == 12 and table.last_batch() == 3


def test_search_sees_the_newest_vector_once(spark, path):
    table = VectorTable.create(vector_frame(spark, unit_vectors(6, 4)), path, 2)
    changed = unit_vectors(1, 4, seed=20)
    table.add_batch(vector_frame(spark, changed))
    out = table.search(query_frame(spark, changed), 6).orderBy("rank").collect()
    assert out[0].id == "p0" and out[0].score == pytest.approx(1.0, abs=1e-6)
    assert len({r.id for r in out}) == len(out) == 6


def test_repeating_a_batch_number_replaces_it(spark, path):
    table = VectorTable.create(vector_frame(spark, unit_vectors(2, 4)), path)
    for title in ("once {}", "again {}"):
        table.add_batch(vector_frame(spark, unit_vectors(2, 4), title=title), batch_no=1)
    assert titles(table) == {"p0": "again 0", "p1": "again 1"} and table.stored().count() == 4


def test_hot_id_within_a_batch(spark, path):
    table = VectorTable.create(vector_frame(spark, unit_vectors(2, 4)), path)
    batch = (
        vector_frame(spark, unit_vectors(1, 4)).crossJoin(spark.range(500).withColumnRenamed("id", "version"))
        .withColumn("article_title", F.concat(F.lit("v"), "version"))
    )
    table.add_batch(batch, order="version")
    assert titles(table) == {"p0": "v499", "p1": "Article 1"}
    assert table.stored().count() == 3


def test_compacting_keeps_the_current_rows(spark, path, tmp_path):
    table = VectorTable.create(vector_frame(spark, unit_vectors(6, 4)), path, 2)
    table.add_batch(vector_frame(spark, unit_vectors(3, 4), title="second {}"))
    whole = table.compact(str(tmp_path / "compact"))
    assert titles(whole) == titles(table) and whole.last_batch() == 0 and whole.stored().count() == 6


def test_single_batch_store_reads_without_a_join(spark, path):
    rows = VectorTable.create(vector_frame(spark, unit_vectors(6, 4)), path, 2).vectors()
    rows.collect()
    assert "Join" not in rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_first_batch_is_not_shuffled_by_a_small_add(spark, path):
    table = VectorTable.create(vector_frame(spark, unit_vectors(6, 4)), path, 2)
    table.add_batch(vector_frame(spark, unit_vectors(2, 4), title="second {}"))
    rows = table.vectors()
    rows.collect()
    final = rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "BroadcastHashJoin" in final and "hashpartitioning" not in final


# --- writers side by side -------------------------------------------------------------


def other_writer_first(table, monkeypatch, add, times=1):
    """Let ``add`` run between the write of the next batch and its log entry."""
    publish, done = table.log.publish, []

    def late(version, state):
        if len(done) < times:
            done.append(version)
            add(VectorTable.load(table._spark, table.path))
        return publish(version, state)

    monkeypatch.setattr(table.log, "publish", late)


def test_writers_between_write_and_log_keep_their_rows(spark, path, monkeypatch):
    table = VectorTable.create(vector_frame(spark, unit_vectors(5, 4)), path, 2)

    def add(other):
        other.add_batch(vector_frame(spark, unit_vectors(4, 4, seed=2), prefix="b", title="other {}"), writer="b")
        other.add_batch(vector_frame(spark, unit_vectors(1, 4, seed=3), title="other {}"), writer="b")

    other_writer_first(table, monkeypatch, add)
    table.add_batch(vector_frame(spark, unit_vectors(3, 4, seed=1), title="mine {}"), writer="a")
    expected = {f"p{i}": f"mine {i}" if i < 3 else f"Article {i}" for i in range(5)}
    assert titles(table) == expected | {f"b{i}": f"other {i}" for i in range(4)}
    # The log has them in the order in which they became visible.
    assert [b["writer"] for b in table.state()["batches"]] == ["create", "b", "b", "a"]
    assert len({b["write"] for b in table.state()["batches"]}) == 4


def test_an_epoch_run_again_beside_another_writer(spark, path, monkeypatch):
    table = VectorTable.create(vector_frame(spark, unit_vectors(6, 4)), path, 2)
    table.add_batch(vector_frame(spark, unit_vectors(4, 4), title="first try {}"), writer="s", epoch=0)
    table.add_batch(vector_frame(spark, unit_vectors(2, 4), title="later {}"), writer="t")

    def add(other):
        other.add_batch(vector_frame(spark, unit_vectors(1, 4), prefix="n", title="meanwhile {}"), writer="t")

    other_writer_first(table, monkeypatch, add)
    table.add_batch(vector_frame(spark, unit_vectors(3, 4), title="again {}"), writer="s", epoch=0)
    # Its rows are replaced where they stood: below the later batch, and p3 is as it was.
    assert titles(table) == {
        "p0": "later 0", "p1": "later 1", "p2": "again 2", "p3": "Article 3", "p4": "Article 4",
        "p5": "Article 5", "n0": "meanwhile 0",
    }


def test_a_write_that_is_never_logged_is_not_seen(spark, path, monkeypatch):
    table = VectorTable.create(vector_frame(spark, unit_vectors(3, 4)), path)
    with monkeypatch.context() as broken:
        broken.setattr(table.log, "publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.add_batch(vector_frame(spark, unit_vectors(2, 4), title="lost {}"))
    assert titles(table) == {f"p{i}": f"Article {i}" for i in range(3)}
    table.add_batch(vector_frame(spark, unit_vectors(1, 4), title="next {}"))
    assert titles(table)["p0"] == "next 0" and titles(table)["p1"] == "Article 1"


def test_a_version_stays_as_it_was(spark, path):
    table = VectorTable.create(vector_frame(spark, unit_vectors(3, 4)), path, 2)
    version = table.log.latest()
    rows = table.vectors(version)
    table.add_batch(vector_frame(spark, unit_vectors(3, 4), title="new {}"))
    assert {r.article_title for r in rows.collect()} == {f"Article {i}" for i in range(3)}
    assert {r.article_title for r in table.vectors(version).collect()} == {f"Article {i}" for i in range(3)}
    assert set(titles(table).values()) == {f"new {i}" for i in range(3)}


def test_numbers_and_versions_have_one_owner(spark, path):
    with ThreadPoolExecutor(8) as pool:
        logs = [CommitLog(spark, path) for _ in range(8)]
        claimed = sorted(pool.map(lambda log: log.claim(0), logs))
        first = list(pool.map(lambda log: log.publish(0, {"by": id(log)}), logs))
    assert claimed == list(range(8))
    assert first.count(True) == 1 and logs[0].read(0) == {"by": id(logs[first.index(True)])}
    for version in range(1, 20):
        assert logs[0].publish(version, {"v": version}) and not logs[1].publish(version, {})
        assert logs[2].latest() == CommitLog(spark, path).latest() == version


def test_many_batches_are_merged(spark, path, monkeypatch):
    monkeypatch.setattr(st, "FANOUT", 3)
    table = VectorTable.create(vector_frame(spark, unit_vectors(8, 4)), path, 2)
    expected = {f"p{i}": f"Article {i}" for i in range(8)}
    for n in range(13):
        rows = vector_frame(spark, unit_vectors(3 if n % 2 else 2, 4, seed=n), title=f"batch {n} {{}}")
        new = vector_frame(spark, unit_vectors(1, 4, seed=n), prefix=f"n{n}x", title=f"new {n} {{}}")
        table.add_batch(rows.unionByName(new), writer="s", epoch=n)
        expected |= {f"p{i}": f"batch {n} {i}" for i in range(3 if n % 2 else 2)} | {f"n{n}x0": f"new {n} 0"}
    assert titles(table) == expected
    assert len(table.state()["batches"]) <= 6 and table.last_batch() >= 13
    with pytest.raises(ValueError, match="merged"):
        table.add_batch(vector_frame(spark, unit_vectors(1, 4)), writer="s", epoch=0)


def test_merging_gives_way_to_another_writer(spark, path, monkeypatch):
    monkeypatch.setattr(st, "FANOUT", 2)
    table = VectorTable.create(vector_frame(spark, unit_vectors(4, 4)), path)
    table.add_batch(vector_frame(spark, unit_vectors(1, 4), title="one {}"), writer="a")
    publish, tries = table.log.publish, []

    def late(version, state):
        tries.append(version)
        if len(tries) == 2:  # the merge, after the add
            with monkeypatch.context() as alone:
                alone.setattr(st, "FANOUT", 99)
                VectorTable.load(spark, path).add_batch(vector_frame(spark, unit_vectors(2, 4), title="late {}"), writer="b")
        return publish(version, state)

    monkeypatch.setattr(table.log, "publish", late)
    table.add_batch(vector_frame(spark, unit_vectors(1, 4, seed=2), prefix="q", title="two {}"), writer="a")
    assert titles(table) == {"p0": "late 0", "p1": "late 1", "p2": "Article 2", "p3": "Article 3", "q0": "two 0"}
    assert all(b["tier"] == 0 for b in table.state()["batches"])


def test_batches_of_new_ids_are_read_without_a_join(spark, path):
    table = VectorTable.create(vector_frame(spark, unit_vectors(4, 4)), path, 2)
    for n in range(4):
        table.add_batch(vector_frame(spark, unit_vectors(2, 4), prefix=f"b{n}x"))
    rows = table.vectors()
    assert rows.count() == 12
    assert "Join" not in rows._jdf.queryExecution().executedPlan().toString()


def test_chosen_shards_are_replaced(spark, path):
    table = VectorTable.create(vector_frame(spark, unit_vectors(16, 4)), path, 4)  # p0, p1 and p8, p9 in shard 0
    table.add_batch(vector_frame(spark, unit_vectors(4, 4), title="second {}"))
    before, version = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/embeddings/**/*.parquet", recursive=True)}, table.log.latest()
    old = titles(table)
    again = vector_frame(spark, unit_vectors(10, 4, seed=3), title="again {}").where("paragraph_id IN ('p0', 'p9')")
    table.replace_shards(again, [0])
    kept = {i: t for i, t in old.items() if i not in ("p0", "p1", "p8", "p9")}
    assert titles(table) == kept | {"p0": "again 0", "p9": "again 9"}
    after = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/embeddings/**/*.parquet", recursive=True)}
    assert before.items() <= after.items() and all("shard_id=0" in f for f in after.keys() - before.keys())
    assert {r.paragraph_id: r.article_title for r in table.vectors(version).collect()} == old
    assert {r.paragraph_id for r in table.shard(0).collect()} == {"p0", "p9"}
    with pytest.raises(Exception, match="not in the shards"):
        table.replace_shards(vector_frame(spark, unit_vectors(4, 4)), [0])
    with pytest.raises(ValueError, match="between 0 and 3"):
        table.replace_shards(again, [4])


def test_rows_added_while_a_shard_is_replaced_stay(spark, path, monkeypatch):
    table = VectorTable.create(vector_frame(spark, unit_vectors(8, 4)), path, 2)

    def add(other):
        other.add_batch(vector_frame(spark, unit_vectors(1, 4), title="meanwhile {}"), writer="b")
        other.add_batch(vector_frame(spark, unit_vectors(1, 4), prefix="n", title="meanwhile {}"), writer="b")

    other_writer_first(table, monkeypatch, add)
    again = vector_frame(spark, unit_vectors(8, 4), title="again {}").where("article_id % 2 = 0")
    table.replace_shards(again, [0])
    expected = {f"p{i}": f"Article {i}" if i // 2 % 2 else f"again {i}" for i in range(8)}
    assert titles(table) == expected | {"p0": "meanwhile 0", "n0": "meanwhile 0"}


def test_vectors_survive_as_floats(spark, path):
    vectors = unit_vectors(3, 4)
    rows = VectorTable.create(vector_frame(spark, vectors), path).vectors().orderBy("paragraph_id").collect()
    np.testing.assert_array_equal(np.array([r.embedding for r in rows], dtype="float32"), vectors)
