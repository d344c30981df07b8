"""One query per operator. Each reads the given tables whole."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry.tables import (
    NUM_SHARDS,
    SPARSE_SHARDS,
    benchmark_requests,
    documents,
    micro,
    paragraphs,
    scaled,
    table,
    vectors,
)
from vecloom.functions import ids, text, vectors as vec
from vecloom.operators import approx, postings, lookup, store
from vecloom.operators.embed import embed_texts, embedder_maker, hash_slots
from vecloom.operators.search import exact_top_k
from vecloom.plans import build, report, requests
from vecloom.session import run_dir, settled, spread
from vecloom.sources import pages, tables as src
from vecloom.streaming.ingest import add_stream

HITS = ("query_id", "rank", "id", "article_id", "article_title")
CARRY = ("article_id", "article_title")
HASHING = embedder_maker("hashing")


# --- helpers -------------------------------------------------------------------------


def _stored(spark, sf, num_shards=NUM_SHARDS) -> store.VectorTable:
    return store.VectorTable.create(vectors(spark, sf), run_dir(spark, "store"), num_shards)


def _corpus(spark, sf) -> DataFrame:
    rows = store.with_shards(vectors(spark, sf), NUM_SHARDS)
    return rows.withColumnRenamed("paragraph_id", "id")


def _samples(spark, sf) -> DataFrame:
    """The ten sample queries: first by id in the lowest shard."""
    corpus = _corpus(spark, sf)
    lowest = corpus.agg(F.min("shard_id")).first()[0]
    first = corpus.where(F.col("shard_id") == F.lit(lowest)).orderBy("id").limit(10)
    return first.select(F.col("id").alias("query_id"), "embedding")


def _every(spark, sf) -> DataFrame:
    """Every vector as a query."""
    return _corpus(spark, sf).select(F.col("id").alias("query_id"), "embedding")


def _embedded(spark, sf) -> DataFrame:
    """All paragraphs, embedded, as a search corpus."""
    rows = build.embed_paragraphs(paragraphs(spark, sf))
    return rows.select(F.col("paragraph_id").alias("id"), "article_title", "embedding")


def _embedded_documents(spark, sf) -> DataFrame:
    docs = documents(spark, sf).select(
        F.col("doc_id").alias("id"), F.col("source").alias("article_title"), "text"
    )
    return embed_texts(docs, HASHING, keep=("id", "article_title"))


def _document_texts(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("paragraph_id"), "text"
    )


def _hits(found: DataFrame, *columns: str) -> DataFrame:
    return found.select(*columns, "score")


# --- A: sources ----------------------------------------------------------------------


def a1_scan_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    path = run_dir(spark, "paragraphs")
    paragraphs(spark, sf).write.parquet(path)
    return src.read_paragraphs(spark, path)


def a2_scan_csv(spark, sf):
    path = run_dir(spark, "customers")
    table(spark, sf, "customer").write.option("header", "true").csv(path)
    return src.read_csv(spark, path).withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


def a2_scan_csv_schema(spark, sf):
    path = run_dir(spark, "customers")
    customers = table(spark, sf, "customer")
    customers.write.option("header", "true").csv(path)
    return src.read_csv(spark, path, customers.schema)


def a3_xml_articles(spark, sf):
    path = run_dir(spark, "dump")
    docs = table(spark, sf, "documents")
    docs.select(pages.to_xml_records("doc_id", "text").alias("value")).write.text(path)
    return pages.read_xml_articles(spark, path)


def a3_xml_nested(spark, sf):
    """Documents as pages that hold another page, end in ``</page >`` and have a second
    extract, which does not count; every fifth has an empty first one."""
    path = run_dir(spark, "dump")
    docs = table(spark, sf, "documents")
    record = pages.to_xml_records("doc_id", "text")
    first = F.when(F.col("doc_id") % 5 == 0, "<extract/>").otherwise("<extract>first\n</extract>")
    outer = F.concat(
        F.lit('<page title="outer '), "doc_id", F.lit('">'), first, F.lit("<extract>second</extract>"),
        record, F.lit("</page >"),
    )
    docs.select(outer.alias("value")).write.text(path)
    return pages.read_xml_articles(spark, path)


def a3_html_titles(spark, sf):
    return pages.html_titles(table(spark, sf, "pages")).select("page_id", "title")


def a4_chunk_paragraphs(spark, sf):
    return paragraphs(spark, sf)


def a5_read_shard(spark, sf):
    return _stored(spark, sf).shard(1).select(
        "paragraph_id", "article_id", "shard_id", micro("embedding").alias("vector")
    )


def _by_label(spark, sf) -> store.VectorTable:
    rows = table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("paragraph_id"),
        F.col("label").cast("bigint").alias("article_id"),
        F.col("label").cast("string").alias("article_title"),
        "embedding",
    )
    return store.VectorTable.create(rows, run_dir(spark, "store"), SPARSE_SHARDS)


def a6_empty_shards(spark, sf):
    return _by_label(spark, sf).empty_shards()


def a7_discover_shards(spark, sf):
    return _by_label(spark, sf).shards()


def a8_load_store(spark, sf):
    loaded = store.VectorTable.load(spark, _stored(spark, sf).path)
    return loaded.vectors().select(
        "paragraph_id", "article_id", "article_title", "shard_id",
        vec.dims("embedding").alias("dims"), micro("embedding").alias("vector"),
    )


def a9_read_queries(spark, sf):
    path = run_dir(spark, "queries")
    _stored(spark, sf).sample_queries(10).write.parquet(path)
    return src.read_queries(spark, path).select(
        "paragraph_id", micro("embedding").alias("vector")
    )


# --- B: sinks ------------------------------------------------------------------------


def b1_partitioned_write(spark, sf):
    path = run_dir(spark, "embeddings")
    rows = store.with_shards(vectors(spark, sf), NUM_SHARDS)
    store.write_shards(rows, path)
    back = spark.read.parquet(path)
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"/(shard_id=\d+)/", 1)
    return back.select(
        "paragraph_id", "article_id", "shard_id", folder.alias("folder"),
        micro("embedding").alias("vector"),
    )


def b1_replace_shards(spark, sf):
    """Shards 1 and 2 are embedded again, without every third article."""
    target = _stored(spark, sf)
    again = vectors(spark, sf).where(F.pmod("article_id", F.lit(NUM_SHARDS)).isin(1, 2) & (F.col("article_id") % 3 > 0))
    target.replace_shards(again.withColumn("article_title", F.lit("again")), [1, 2])
    return target.vectors().select("paragraph_id", "article_id", "article_title", "shard_id")


def b2_sample_queries(spark, sf):
    return _stored(spark, sf).sample_queries(10).select(
        "paragraph_id", micro("embedding").alias("vector")
    )


def b3_save_id_map(spark, sf):
    return _stored(spark, sf).write_id_map(run_dir(spark, "id_map"))


def _event_metrics(spark, sf) -> DataFrame:
    """Metric rows, one per event type: its events as rows, its values as seconds."""
    totals = table(spark, sf, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("duration_s")
    )
    return totals.select(
        F.col("event_type").alias("stage"),
        "duration_s",
        report.throughput("n", "duration_s").alias("throughput"),
        F.lit("events/s").alias("throughput_unit"),
        F.lit(1).alias("worker_count"),
        F.create_map(F.lit("num_rows"), F.col("n").cast("string")).alias("extra"),
    )


def b4_append_metrics(spark, sf):
    path = run_dir(spark, "metrics")
    rows = _event_metrics(spark, sf)
    report.append_metrics(rows, path)
    report.append_metrics(rows.withColumn("worker_count", F.lit(2)), path)
    return report.read_metrics(spark, path).select(
        "stage",
        F.round("duration_s", 4).alias("duration_s"),
        F.round("throughput", 6).alias("throughput"),
        "throughput_unit",
        "worker_count",
        F.col("extra")["num_rows"].alias("num_rows"),
    )


def b5_run_report(spark, sf):
    path = run_dir(spark, "report")
    stats = report.shard_stats(store.with_shards(vectors(spark, sf), NUM_SHARDS))
    report.write_report(
        report.run_report(stats, {"embedder": "given", "num_shards": NUM_SHARDS}), path
    )
    return (
        spark.read.json(path)
        .select("embedder", "num_shards", "num_paragraphs", F.explode("shard_stats").alias("s"))
        .select(
            "embedder", "num_shards", "num_paragraphs", "s.shard_id", "s.num_vectors",
            "s.num_articles", "s.raw_bytes",
        )
    )


# --- C: projections, filters, scalar functions ----------------------------------------


def c1_project(spark, sf):
    rows = paragraphs(spark, sf).withColumn("shard_id", ids.shard_of("article_id", NUM_SHARDS))
    return rows.select("paragraph_id", "article_id", "article_title", "shard_id", "text")


def c2_shard_key(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        ids.shard_of("doc_id", NUM_SHARDS).alias("shard_id"),
        ids.shard_of(-F.col("doc_id"), 7).alias("negative_key_shard"),
        ids.shard_of("doc_id", 1).alias("single_shard"),
    )


def c3_filter_equal(spark, sf):
    return src.where_equal(table(spark, sf, "customer"), "c_nationkey", 7)


def _pieces(spark, sf) -> DataFrame:
    """The text between the tags of every page; most pieces are blank."""
    return table(spark, sf, "pages").select(
        "page_id", F.posexplode(F.split("html", "<[^>]*>")).alias("position", "text")
    )


def c4_keep_texts(spark, sf):
    return text.keep_texts(_pieces(spark, sf), "text")


def c5_reject_blank(spark, sf):
    valid, rejected = text.reject_blank(_pieces(spark, sf), "text", "Text cannot be empty")
    both = valid.withColumn("error", F.lit("none")).unionByName(rejected)
    return both.groupBy("page_id", "error").agg(F.count(F.lit(1)).alias("n"))


def c6_exclude_self(spark, sf):
    found = exact_top_k(_every(spark, sf), _corpus(spark, sf), 5, carry=CARRY, exclude_self=True)
    return _hits(found, *HITS)


def c7_limit_if_positive(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    some = src.limit_if_positive(customers, 20, "c_custkey").withColumn("row_limit", F.lit(20))
    every = src.limit_if_positive(customers, 0, "c_custkey").withColumn("row_limit", F.lit(0))
    return some.unionByName(every)


def c8_bounded_k(spark, sf):
    """Each request states its own count; 0 and more than 50 are refused."""
    asked = benchmark_requests(spark, sf).withColumn(
        "k", F.pmod(F.substring("query_id", 2, 20).cast("int"), F.lit(60))
    )
    answers, rejected = requests.text_search(
        asked, _embedded(spark, sf), paragraphs(spark, sf), HASHING
    )
    counted = answers.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_results"))
    return counted.withColumn("error", F.lit("none")).unionByName(
        rejected.select("query_id", F.lit(0).cast("bigint").alias("n_results"), "error")
    )


def c9_skip_empty_batches(spark, sf):
    """The documents beside a scan without rows, whose tasks get empty batches or none."""
    docs = table(spark, sf, "documents")
    both = docs.where(F.col("n_chars") < 0).unionAll(docs)
    rows = embed_texts(both, HASHING, keep=("doc_id", "lang"))
    return rows.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.min(vec.dims("embedding")).alias("dims")
    )


def c10_preview(spark, sf):
    return src.preview(table(spark, sf, "customer"), 10, "c_custkey")


def c11_numeric_id(spark, sf):
    return paragraphs(spark, sf).select(
        "paragraph_id", ids.numeric_id("paragraph_id").alias("vector_id")
    )


def c12_metadata_json(spark, sf):
    scored = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    written = scored.select("doc_id", ids.to_metadata_json("source", "quality").alias("metadata_json"))
    parsed = ids.from_metadata_json("metadata_json", "source string, quality int")
    return written.withColumn("m", parsed).select(
        "doc_id", "metadata_json", "m.source", F.coalesce("m.quality", F.lit(-1)).alias("quality")
    )


def c13_empty_metadata(spark, sf):
    marks = table(spark, sf, "labels").select(
        "doc_id",
        F.create_map(F.lit("quality"), F.col("quality").cast("string"),
                     F.lit("toxic"), F.col("toxic").cast("string")).alias("metadata"),
    )
    joined = table(spark, sf, "documents").select("doc_id").join(marks, "doc_id", "left")
    whole = ids.metadata_or_empty("metadata")
    return joined.select("doc_id", F.size(whole).alias("n_keys"),
                         F.coalesce(F.try_element_at(whole, F.lit("quality")), F.lit("none")).alias("quality"))


def c14_casts(spark, sf):
    thirds = F.transform("embedding", lambda x: x.cast("double") / F.lit(3.0))
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"),
        F.pmod("vec_id", F.lit(NUM_SHARDS)).cast("int").alias("shard_id"),
        vec.as_floats(thirds).alias("embedding"),
    ).select("id", "shard_id", micro("embedding").alias("vector"))


def c15_unit_vectors(spark, sf):
    rows = scaled(spark, sf).withColumn("embedding", vec.unit("embedding"))
    return rows.select("vec_id", micro("embedding").alias("vector"))


def _neighbouring(spark, sf) -> DataFrame:
    rows = scaled(spark, sf)
    after = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("following"))
    return rows.join(after, "vec_id")


def c16_pair_scores(spark, sf):
    return _neighbouring(spark, sf).select(
        "vec_id",
        F.round(vec.inner_product("embedding", "following"), 6).alias("inner_product"),
        F.round(vec.cosine("embedding", "following"), 6).alias("cosine"),
    )


def c17_similarity(spark, sf):
    pairs = _neighbouring(spark, sf).withColumn(
        "distance", F.lit(1.0) - vec.cosine("embedding", "following")
    )
    return pairs.select(
        "vec_id",
        F.round(vec.similarity("distance"), 6).alias("score"),
        F.round(vec.similarity_from_euclidean(F.sqrt(F.col("distance") * 2)), 6)
        .alias("score_from_euclidean"),
    )


def c18_length(spark, sf):
    return report.by_length(table(spark, sf, "documents"), "text").select("doc_id", "text_length")


def c19_dims(spark, sf):
    size = vec.dims("embedding")
    return table(spark, sf, "embeddings").groupBy("label").agg(
        F.min(size).alias("least"), F.max(size).alias("most"),
        (F.min(size) == F.max(size)).alias("agree"),
    )


def c20_alignment(spark, sf):
    """Documents lined up with vectors by number; some have none."""
    stored = table(spark, sf, "embeddings").withColumnRenamed("vec_id", "doc_id")
    rows = table(spark, sf, "documents").join(stored, "doc_id", "left")
    return rows.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~vec.is_complete("embedding")).alias("n_incomplete"),
    )


def c21_rounding(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        F.round(F.col("value") / 7, 4).alias("four"),
        F.round(F.col("value") / 7, 2).alias("two"),
    )


# --- D: joins ------------------------------------------------------------------------


def d1_score_blocks(spark, sf):
    """Benchmark texts against all paragraphs on the block-by-block route, which holds
    neither side whole."""
    asked = embed_texts(benchmark_requests(spark, sf), HASHING, keep=("query_id",))
    # This route reads both sides twice, to size the blocks and to fill them.
    asked, corpus = settled(asked, "queries"), settled(_embedded(spark, sf), "corpus")
    found = exact_top_k(asked, corpus, 5, limit_bytes=0)
    return _hits(found, "query_id", "rank", "id")


def d2_resolve_ids(spark, sf):
    corpus = _corpus(spark, sf)
    numbered = corpus.select(ids.numeric_id("id").alias("id"), "embedding")
    hits = exact_top_k(_every(spark, sf), numbered, 10).withColumnRenamed("id", "vector_id")
    return _hits(
        lookup.resolve_ids(hits, store.id_map(vectors(spark, sf))),
        "query_id", "rank", "paragraph_id", "metadata_json",
    )


def _requested(spark, sf) -> tuple[DataFrame, DataFrame]:
    wanted = table(spark, sf, "orders").select(F.col("o_custkey").alias("doc_id"))
    return lookup.known_and_unknown(wanted, table(spark, sf, "documents"), "doc_id")


def d3_lookup_known(spark, sf):
    return _requested(spark, sf)[0].select("doc_id", "lang", "source", "n_chars")


def d3_lookup_unknown(spark, sf):
    return _requested(spark, sf)[1]


def d4_hydrate(spark, sf):
    labelled = table(spark, sf, "labels").select("doc_id", "quality")
    hits = labelled.select(F.concat_ws("_", "doc_id", "quality").alias("id"), "quality")
    rows = lookup.hydrate(hits, paragraphs(spark, sf), ("article_title", "text"))
    return rows.fillna("missing", ["article_title", "text"])


def d4_hydrate_by_shard(spark, sf):
    """The same lookups from texts that lie by shard, for labels of two shards in four."""
    path = run_dir(spark, "texts")
    lookup.write_texts(paragraphs(spark, sf), path, NUM_SHARDS)
    labelled = table(spark, sf, "labels").where(F.pmod("doc_id", F.lit(NUM_SHARDS)).isin(1, 3))
    hits = labelled.select(
        F.concat_ws("_", "doc_id", "quality").alias("id"), F.col("doc_id").alias("article_id"), "quality"
    )
    rows = lookup.hydrate_by_shard(hits, path, NUM_SHARDS, ("article_title", "text"))
    return rows.fillna("missing", ["article_title", "text"])


# --- E: aggregations and reports ------------------------------------------------------


def e1_count(spark, sf):
    return paragraphs(spark, sf).agg(F.count(F.lit(1)).alias("n_paragraphs"))


def e2_filtered_count(spark, sf):
    rows = src.where_equal(table(spark, sf, "customer"), "c_nationkey", 7)
    return rows.agg(F.count(F.lit(1)).alias("n"))


def e3_shard_stats(spark, sf):
    built = _stored(spark, sf)
    return report.shard_counts(built.vectors(), built.dim)


def e4_latency_stats(spark, sf):
    stats = report.latency_stats(table(spark, sf, "events"), "value", "event_type")
    return stats.select("event_type", "n", F.round("mean", 6).alias("mean"), "p50", "p95")


def e5_throughput(spark, sf):
    totals = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(0.0)).alias("s"),
    )
    return totals.select(
        "o_custkey", F.round(report.throughput("n", "s"), 9).alias("throughput")
    )


def e6_stored_size(spark, sf):
    """Bytes of the paragraphs written as plain text, one to a line."""
    path = run_dir(spark, "texts")
    paragraphs(spark, sf).select("text").write.text(path)
    return report.stored_size(spark, path).select("total_bytes")


def e7_collisions(spark, sf):
    """16-bit ids, narrow enough to collide."""
    return store.id_collisions(paragraphs(spark, sf), bits=16)


def _runs(spark, sf) -> DataFrame:
    """Events as runs: one row each, on 1, 2, 4 or 8 workers by user."""
    return table(spark, sf, "events").select(
        F.pow(F.lit(2), F.pmod("user_id", F.lit(4))).cast("int").alias("worker_count"),
        F.lit(1).cast("bigint").alias("num_rows"),
        F.col("value").alias("duration_s"),
        "event_type",
    )


def e8_worker_scaling(spark, sf):
    rows = report.worker_scaling(_runs(spark, sf), "event_type")
    return rows.select(
        "event_type", "worker_count", "num_rows", F.round("throughput", 9).alias("throughput"),
        F.round("speedup", 6).alias("speedup"), "is_peak",
    )


def e9_compare_settings(spark, sf):
    runs = _runs(spark, sf).withColumn(
        "mode", F.when(F.col("worker_count") == 1, "centralized").otherwise("sharded")
    )
    stats = report.latency_stats(runs, "duration_s", "event_type", "mode")
    stats = stats.withColumn("mean", F.round("mean", 6))
    return report.compare_settings(stats, "event_type", "mode", ["centralized", "sharded"])


# --- F: ranking and search ------------------------------------------------------------


def f1_longest(spark, sf):
    return report.longest(table(spark, sf, "documents"), "text", "doc_id")


def f2_exact_topk(spark, sf):
    found = exact_top_k(_samples(spark, sf), _corpus(spark, sf), 10, carry=CARRY)
    return _hits(found, *HITS)


def f2_exact_topk_cosine(spark, sf):
    corpus = scaled(spark, sf).withColumnRenamed("vec_id", "id")
    asked = _every(spark, sf)
    return _hits(exact_top_k(asked, corpus, 10, metric="cosine"), "query_id", "rank", "id")


def f3_shard_merge(spark, sf):
    found = exact_top_k(_samples(spark, sf), _corpus(spark, sf), 10, carry=CARRY, by="shard_id")
    return _hits(found, *HITS, "shard_id")


def f2_bounded_topk(spark, sf):
    """Exact search that reads the blocks whose bounds reach the k-th best; every vector asks."""
    built = _stored(spark, sf).build_bounded(num_cells=8)
    return _hits(built.search(_every(spark, sf), 10, method="bounded"), "query_id", "rank", "id")


def f4_k_beyond_corpus(spark, sf):
    """Benchmark texts against the region names: fewer rows than k."""
    names = table(spark, sf, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("text"))
    asked = embed_texts(benchmark_requests(spark, sf), HASHING, keep=("query_id",))
    found = exact_top_k(asked, embed_texts(names, HASHING, keep=("id",)), 10)
    return _hits(found, "query_id", "rank", "id")


def f5_routes(spark, sf):
    """The same search with 1, 4 and 7 shards."""
    parts = []
    for count in (1, 4, 7):
        corpus = store.with_shards(vectors(spark, sf), count).withColumnRenamed("paragraph_id", "id")
        by = "shard_id" if count > 1 else None
        found = exact_top_k(_every(spark, sf), corpus, 10, by=by)
        parts.append(_hits(found, "query_id", "rank", "id").withColumn("num_shards", F.lit(count)))
    return store.unite(parts)


LSH = {"dim": 64, "tables": 4, "bits": 4}


def _lsh(spark, sf, asked: DataFrame, **options) -> DataFrame:
    return approx.top_k_in_cells(
        approx.hyperplane_cells(asked, **LSH),
        approx.hyperplane_cells(_corpus(spark, sf).select("id", "embedding"), **LSH),
        10,
        num_cells=LSH["tables"] << LSH["bits"],
        **options,
    )


def f6_lsh_topk(spark, sf):
    return _hits(_lsh(spark, sf, _every(spark, sf)), "query_id", "rank", "id")


def f6_lsh_topk_cells(spark, sf):
    """Every vector is a query; the two sides meet cell by cell."""
    asked = _corpus(spark, sf).select(F.col("id").alias("query_id"), "embedding")
    return _hits(_lsh(spark, sf, asked, limit_bytes=0), "query_id", "rank", "id")


def f6_postings_topk(spark, sf):
    """In each table the three buckets nearest to the query; every vector is a query."""
    built = _stored(spark, sf).build_postings(tables=4, bits=4)
    found = built.search(_every(spark, sf), 10, method="postings", probes=3)
    return _hits(found, "query_id", "rank", "id")


def f6_postings_share(spark, sf):
    """What ten queries have scored, and how much of the exact rows they find, by probes."""
    built = _stored(spark, sf).build_postings(tables=4, bits=4)
    asked = built.sample_queries(10).withColumnRenamed("paragraph_id", "query_id")
    exact = built.search(asked, 10)
    _, path = built._index("postings")
    parts = []
    for probes in (1, 4, 16):
        found = built.search(asked, 10, method="postings", probes=probes)
        hit = approx.recall(found, exact).agg(F.avg("recall")).first()[0]
        share = postings.share_read(asked, path, probes).select("probes", "n_candidates", "n_rows")
        parts.append(share.withColumn("recall", F.round(F.lit(hit), 6)))
    return store.unite(parts)


def f6_ivf_topk(spark, sf):
    """Clusters around the mean vector of each label; a query probes the nearest four."""
    means = table(spark, sf, "embeddings").groupBy("label").agg(
        F.array(*[F.avg(F.get("embedding", F.lit(i))) for i in range(64)]).alias("centre")
    )
    # One row per label.
    rows = means.orderBy("label").limit(approx.MAX_CENTRES + 1).collect()
    if len(rows) > approx.MAX_CENTRES:
        raise ValueError("too many labels to be centres")
    centres = np.array([row.centre for row in rows])
    built = _stored(spark, sf).build_ivf(centres=centres)
    found = built.search(_every(spark, sf), 10, method="ivf", probes=4)
    return _hits(found, "query_id", "rank", "id")


def f6_ivf_all_cells(spark, sf):
    """Fitted clusters, all of them probed: the exact result."""
    built = _stored(spark, sf).build_ivf(num_cells=16)
    found = built.search(_every(spark, sf), 10, method="ivf", probes=16)
    return _hits(found, "query_id", "rank", "id")


def f7_recall(spark, sf):
    asked = _every(spark, sf)
    exact = exact_top_k(asked, _corpus(spark, sf), 10)
    rows = approx.recall(_lsh(spark, sf, asked), exact)
    return rows.withColumn("recall", F.round("recall", 6))


def f8_text_search(spark, sf):
    answers, _ = requests.text_search(
        benchmark_requests(spark, sf), _embedded(spark, sf), paragraphs(spark, sf), HASHING
    )
    return answers.select(*requests.ANSWER)


def f8_rejected(spark, sf):
    """Every piece between tags as a request."""
    asked = _pieces(spark, sf).select(
        F.concat_ws("_", "page_id", "position").alias("query_id"), "text"
    )
    _, rejected = requests.split_requests(asked)
    return rejected.select("query_id", "error")


def f8_conversations(spark, sf):
    """Every user turn as a request, answered with one array each."""
    asked = table(spark, sf, "conversations").where(F.col("role") == "user").select(
        F.concat_ws("_", "conv_id", "turn").alias("query_id"), "text"
    )
    answers, _ = requests.text_search(
        asked, _embedded(spark, sf), paragraphs(spark, sf), HASHING
    )
    rows = requests.responses(answers)
    return rows.select("query_id", F.array_join("results.doc_id", ",").alias("doc_ids"))


def f8_repeated_ids(spark, sf):
    """Every turn as a request under the conversation's number, which repeats, and null for
    the assistant's turns: each is answered or refused."""
    user = F.when(F.col("role") == "user", F.col("conv_id"))
    asked = table(spark, sf, "conversations").select(
        user.alias("query_id"), "text", F.pmod("conv_id", F.lit(60)).cast("int").alias("k")
    )
    answers, rejected = requests.text_search(
        asked, _embedded(spark, sf), paragraphs(spark, sf), HASHING
    )
    rows = requests.responses(answers).select(
        "query_id", F.col("query").alias("text"), F.array_join("results.doc_id", ",").alias("outcome")
    )
    rows = rows.unionAll(rejected.select("query_id", "text", F.col("error").alias("outcome")))
    return rows.withColumn("query_id", F.col("query_id").cast("string"))


def f9_similar(spark, sf):
    """Neighbours of every document among all documents."""
    wanted = table(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    # Written once: the lookup and the search both read the vectors.
    corpus = settled(_embedded_documents(spark, sf), "documents")
    answers, _ = requests.similar_documents(wanted, corpus, _document_texts(spark, sf))
    return answers


def f9_unknown(spark, sf):
    """Every order's customer number as a requested document, and the document numbers
    that documents without a label lack, which are null."""
    labels = table(spark, sf, "labels").select("doc_id", F.col("doc_id").alias("id"))
    missing = table(spark, sf, "documents").join(labels, "doc_id", "left").select("id")
    wanted = table(spark, sf, "orders").select(F.col("o_custkey").alias("id")).unionAll(missing)
    corpus = table(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    unknown = requests.unknown_documents(wanted, corpus)
    return unknown.withColumn("id", F.col("id").cast("string"))


def f10_embed(spark, sf):
    turns = table(spark, sf, "conversations").select(
        F.concat_ws("_", "conv_id", "turn").alias("id"), "text"
    )
    embedded, _ = requests.embed_requests(turns, HASHING, keep=("id",))
    return embedded.select("id", "text", micro("embedding").alias("vector"), "dims")


# --- G: union and partitioning --------------------------------------------------------


def g1_unite_shards(spark, sf):
    stored = _stored(spark, sf)
    whole = store.unite([stored.shard(n) for n in range(NUM_SHARDS)])
    return whole.select("paragraph_id", "article_id", "article_title", "shard_id")


def g2_spread(spark, sf):
    """The documents, and whether they now lie in at least one part per core."""
    rows = spread(table(spark, sf, "documents"), "doc_id")
    parts = rows.select(F.spark_partition_id().alias("part")).distinct().count()
    enough = parts >= spark.sparkContext.defaultParallelism
    return rows.select("doc_id", "lang", F.lit(enough).alias("enough_parts"))


def g3_bounded_batches(spark, sf):
    """Seven texts per model call give the same vectors as 1,024."""
    rows = embed_texts(documents(spark, sf), HASHING, keep=("doc_id",), rows_per_call=7)
    return rows.select("doc_id", micro("embedding").alias("vector"))


# --- I, J: embedders and the store ----------------------------------------------------


def i1_embed_paragraphs(spark, sf):
    rows = build.embed_paragraphs(paragraphs(spark, sf), num_shards=NUM_SHARDS)
    return rows.select(
        "paragraph_id", "article_id", "article_title", "shard_id", micro("embedding").alias("vector")
    )


def i2_other_dimension(spark, sf):
    make = embedder_maker("hashing", dim=8)
    rows = embed_texts(benchmark_requests(spark, sf), make, keep=("query_id",))
    return rows.select("query_id", micro("embedding").alias("vector"))


def i3_embedder_by_name(spark, sf):
    rows = build.embed_paragraphs(paragraphs(spark, sf), embedder="hashing", dim=16)
    return rows.groupBy("article_id").agg(
        F.count(F.lit(1)).alias("n"), F.min(vec.dims("embedding")).alias("dims")
    )


def i4_hash_slots(spark, sf):
    rows = hash_slots(paragraphs(spark, sf), "paragraph_id")
    return rows.select("paragraph_id", "slot", F.round(F.col("weight").cast("double"), 6).alias("weight"))


def i5_store_search(spark, sf):
    path = run_dir(spark, "built")
    build.build_store(paragraphs(spark, sf), path, num_shards=NUM_SHARDS)
    built = store.VectorTable.load(spark, path)
    asked = embed_texts(benchmark_requests(spark, sf), HASHING, keep=("query_id",))
    return _hits(built.search(asked, 5, method="sharded"), *HITS)


def _changed(spark, sf) -> DataFrame:
    """A second batch: the vectors of labels 0 to 2 under a new title, each twice, and a
    copy of every vector under a new id."""
    rows = vectors(spark, sf)
    old = rows.where(F.col("article_title").isin("label 0", "label 1", "label 2"))
    versions = [
        old.withColumn("article_title", F.lit(f"version {n}")).withColumn("version", F.lit(n))
        for n in (1, 2)
    ]
    new = rows.withColumn("paragraph_id", F.concat("paragraph_id", F.lit("_copy")))
    return store.unite([*versions, new.withColumn("version", F.lit(1))])


def j1_add_batch(spark, sf):
    added = _stored(spark, sf).add_batch(_changed(spark, sf), order="version")
    return added.vectors().select("paragraph_id", "article_id", "article_title", "shard_id")


def j1_compact(spark, sf):
    added = _stored(spark, sf).add_batch(_changed(spark, sf), order="version")
    whole = added.compact(run_dir(spark, "compacted"))
    return whole.vectors().select("paragraph_id", "article_id", "article_title", "shard_id")


def j1_stream_add(spark, sf):
    """All paragraphs arrive as a stream into a store that holds the given vectors."""
    arriving = run_dir(spark, "arriving")
    paragraphs(spark, sf).write.parquet(arriving)
    stream = spark.readStream.schema(src.PARAGRAPH_SCHEMA).parquet(arriving)
    target = _stored(spark, sf)
    add_stream(stream, target, HASHING, run_dir(spark, "progress")).awaitTermination()
    return target.vectors().select("paragraph_id", "article_id", "article_title", "shard_id")


def j1_stream_into_batches(spark, sf):
    """The same stream into a store that holds a second batch already, then another."""
    arriving = run_dir(spark, "arriving")
    paragraphs(spark, sf).write.parquet(arriving)
    target = _stored(spark, sf).add_batch(_changed(spark, sf), order="version")
    for name in ("one", "two"):
        stream = spark.readStream.schema(src.PARAGRAPH_SCHEMA).parquet(arriving)
        stream = stream.withColumn("paragraph_id", F.concat(F.lit(f"{name} "), "paragraph_id"))
        add_stream(stream, target, HASHING, run_dir(spark, "progress")).awaitTermination()
    return target.vectors().select("paragraph_id", "article_id", "article_title", "shard_id")


def j1_two_streams(spark, sf):
    """Two streams add to one store at the same time, a third of the files after another."""
    target = _stored(spark, sf)
    texts = settled(paragraphs(spark, sf), "paragraphs")
    # No task gets a whole third: each is as many files as the scan has tasks.
    arriving, files = run_dir(spark, "arriving"), texts.rdd.getNumPartitions()
    for part in range(3):
        third = texts.where(F.pmod(F.xxhash64("paragraph_id"), F.lit(3)) == part)
        third.write.mode("append").parquet(arriving)
    running = []
    for name in ("one", "two"):
        stream = spark.readStream.schema(src.PARAGRAPH_SCHEMA).option("maxFilesPerTrigger", files).parquet(arriving)
        stream = stream.withColumn("paragraph_id", F.concat(F.lit(f"{name} "), "paragraph_id"))
        running.append(add_stream(stream, target, HASHING, run_dir(spark, "progress")))
    for query in running:
        query.awaitTermination()
    return target.vectors().select("paragraph_id", "article_id", "article_title", "shard_id")


def j1_many_batches(spark, sf):
    """Eighteen batches that replace fewer and fewer vectors, the first sixteen merged on the way."""
    target = _stored(spark, sf)
    for number in range(1, 19):
        batch = vectors(spark, sf).where(F.pmod("article_id", F.lit(19)) >= number)
        target.add_batch(batch.withColumn("article_title", F.lit(f"batch {number}")))
    return target.vectors().select("paragraph_id", "article_id", "article_title", "shard_id")


def j1_earlier_version(spark, sf):
    """The store before and after a batch, both read after it."""
    target = _stored(spark, sf)
    before = target.log.latest()
    target.add_batch(_changed(spark, sf), order="version")
    rows = [target.vectors(v).withColumn("version", F.lit(n)) for n, v in enumerate((before, before + 1))]
    return store.unite(rows).select("paragraph_id", "article_id", "article_title", "shard_id", "version")


def f7_fitted_share(spark, sf):
    """Clusters fitted on every row and on an asked share, all probed: both exact."""
    found = []
    for share in (1.0, 0.5):
        built = _stored(spark, sf).build_ivf(num_cells=2, share=share)
        hits = _hits(built.search(_every(spark, sf), 3, method="ivf", probes=2), "query_id", "rank", "id")
        found.append(hits.withColumn("share", F.lit(share)))
    return store.unite(found)


QUERIES = {
    name: function
    for name, function in list(globals().items())
    if callable(function) and name[0] in "abcdefgij" and name[1:2].isdigit()
}
