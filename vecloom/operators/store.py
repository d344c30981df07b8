"""The vector table: sharded Parquet, appended in batches, newest row per id.

Layout under the store's folder::

    log/                                        one small file per version (commits.py)
    claims/                                     numbers of batches that a writer has taken
    embeddings/batch_no=B/shard_id=N/*.parquet
    hidden/by=B/of=A/*.parquet                  ids of batch A that batch B replaced
    flat/, lsh/, ivf/, postings/, bounded/      covers/: one row per finished build, and its folder

Adding a batch claims a number, writes its own folder and then the next version of the log;
if another writer was first, what that one added is compared and the version after is tried.
So writers wait for nobody and lose nothing, and a batch is seen whole or not at all. The
order of the versions is that of the batches.

What a batch replaces is found when it is added, from the ids alone, and written beside it.
Reading is a plain scan of all batches of which nothing was replaced; only the others are
compared with the ids hidden in them. Small batches are merged, FANOUT of a size at a time, so
their number grows with the logarithm of the batches ever added.

A batch belongs to its writer: the same writer may write its number, or its epoch, again,
which replaces that batch where it stands, so a failed add can be repeated; another writer's
number is refused.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable
from functools import reduce

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.functions.ids import (
    SHARD_COLUMN,
    check_num_shards,
    numeric_id,
    shard_of,
    to_metadata_json,
)
from vecloom.functions.vectors import dims, is_complete
from vecloom.operators import approx, bounded, postings
from vecloom.operators.commits import CommitLog
from vecloom.operators.search import exact_top_k, packed

VECTOR_COLUMNS = ("paragraph_id", "article_id", "article_title", "embedding")
HIDDEN = "paragraph_id string, by int, of int"
STORED_SCHEMA = T.StructType(
    [
        T.StructField("paragraph_id", T.StringType()),
        T.StructField("article_id", T.LongType()),
        T.StructField("article_title", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("batch_no", T.IntegerType()),
        T.StructField(SHARD_COLUMN, T.IntegerType()),
    ]
)
# The writer of batch 0.
CREATOR = "create"
# So many batches of a size become one.
FANOUT = 16
CARRY = ("article_id", "article_title")
APPROXIMATE = ("lsh", "ivf", "postings")


def checked(vectors: DataFrame, dim: int | None = None) -> DataFrame:
    """The rows unchanged; a missing id, an incomplete vector or a wrong dimension
    fails the job that reads them, without a pass of its own."""
    problem = F.when(F.col("paragraph_id").isNull(), "paragraph_id is null").when(
        ~is_complete("embedding"), "embedding is null or has a null or non-finite element"
    )
    if dim is not None:
        problem = problem.when(dims("embedding") != dim, f"embedding must have {dim} dimensions")
    return vectors.withColumn(
        "embedding",
        F.when(problem.isNotNull(), F.raise_error(problem)).otherwise(F.col("embedding")),
    )


def zip_batch(ids: Column | str, vectors: Column | str, metadata: Column | str) -> Column:
    """Parallel arrays of one batch row as an array of structs; uneven lengths fail."""
    even = (F.size(ids) == F.size(vectors)) & (F.size(ids) == F.size(metadata))
    return F.when(even, F.arrays_zip(ids, vectors, metadata)).otherwise(
        F.raise_error(F.lit("ids, vectors and metadata must have the same length"))
    )


def with_shards(vectors: DataFrame, num_shards: int) -> DataFrame:
    return vectors.withColumn(SHARD_COLUMN, shard_of("article_id", num_shards))


def write_shards(vectors: DataFrame, path: str, compact: bool = True) -> None:
    """Overwrite ``path`` with one folder per shard.

    ``compact`` rebalances by shard first: adaptive execution then splits a large
    shard over many tasks and gathers small ones, so each shard gets a few files of
    the advisory size instead of one per input task.
    """
    if compact:
        vectors = vectors.hint("rebalance", SHARD_COLUMN)
    vectors.write.mode("overwrite").partitionBy(SHARD_COLUMN).parquet(path)


def id_map(vectors: DataFrame) -> DataFrame:
    """``(vector_id, paragraph_id, metadata_json)``."""
    return vectors.select(
        numeric_id("paragraph_id").alias("vector_id"),
        "paragraph_id",
        to_metadata_json(*CARRY).alias("metadata_json"),
    )


def id_collisions(ids: DataFrame, bits: int = 64) -> DataFrame:
    """``(vector_id, n_ids)`` for numeric ids that different string ids share. Repeats
    of one id collapse in the map-side half of the distinct."""
    return (
        ids.select(numeric_id("paragraph_id", bits).alias("vector_id"), "paragraph_id")
        .distinct()
        .groupBy("vector_id")
        .agg(F.count(F.lit(1)).alias("n_ids"))
        .where(F.col("n_ids") > 1)
    )


def refuse_collisions(ids: DataFrame, bits: int = 64) -> None:
    clash = id_collisions(ids, bits).first()
    if clash is not None:
        raise ValueError(f"id collision: {clash.n_ids} ids share numeric id {clash.vector_id}")


def unite(parts: Iterable[DataFrame]) -> DataFrame:
    """The shards' vectors as one set; nothing is embedded again."""
    return reduce(DataFrame.unionByName, parts)


def newest(rows: DataFrame, order: str | None = None) -> DataFrame:
    """One row per id: the one with the highest ``order``, or without one the highest in
    column order. The maximum is taken map-side first, so an id repeated many times
    reaches its reducer as a few rows."""
    others = F.struct(*[name for name in rows.columns if name != "paragraph_id"])
    return (
        rows.groupBy("paragraph_id")
        .agg(F.max_by(others, F.col(order) if order else others).alias("last"))
        .select("paragraph_id", "last.*")
    )


def counted_ids(rows: DataFrame) -> DataFrame:
    """``(paragraph_id, n)``: each id and the number of its rows."""
    return rows.groupBy("paragraph_id").agg(F.count(F.lit(1)).alias("n"))


def one_per_id(rows: DataFrame, order: str | None = None, ids: DataFrame | None = None) -> DataFrame:
    """:func:`newest`, but vectors are only moved if some id does repeat. ``ids``: the rows'
    :func:`counted_ids`, from a caller who needs them again."""
    ids = counted_ids(rows) if ids is None else ids
    return rows if ids.where("n > 1").isEmpty() else newest(rows, order)


class VectorTable:
    """A stored set of vectors: add, search, save, load."""

    def __init__(
        self, spark: SparkSession, path: str, num_shards: int, dim: int | None = None
    ) -> None:
        self._spark = spark
        self.path = path
        self.num_shards = check_num_shards(num_shards)
        self.dim = dim
        self.log = CommitLog(spark, path)

    @classmethod
    def create(
        cls, vectors: DataFrame, path: str, num_shards: int = 1, dim: int | None = None
    ) -> VectorTable:
        """Write ``vectors`` (paragraph_id, article_id, article_title, embedding) as batch 0
        of a new store; of a repeated id the highest row in column order stays. A store's
        folder holds one sharding only."""
        table = cls(vectors.sparkSession, path, num_shards, dim)
        table.refuse_existing()
        number = table.log.claim(0)
        table._write(checked(one_per_id(vectors.select(*VECTOR_COLUMNS)), dim), number)
        return table.commit(number, CREATOR)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> VectorTable:
        table = cls(spark, path, 1)
        made = table.state()
        if not made["batches"]:
            raise ValueError(f"no store under {path}")
        table.num_shards, table.dim = made["num_shards"], made["dim"]
        return table

    def refuse_existing(self) -> None:
        """A new store needs a folder of its own: shards of two settings never mix."""
        if self.log.latest() >= 0:
            raise ValueError(f"there is a store under {self.path} already")

    def state(self, version: int | None = None) -> dict:
        """The batches as they are now, or were in an earlier version of the log."""
        if version is None:
            version = self.log.latest()
        if version < 0:
            return {"version": -1, "changes": 0, "batches": []}
        return {**self.log.read(version), "version": version}

    def folder(self, write: int) -> str:
        return f"{self.path}/embeddings/batch_no={write}"

    def _write(self, vectors: DataFrame, write: int, compact: bool = True) -> None:
        rows = with_shards(vectors.select(*VECTOR_COLUMNS), self.num_shards)
        write_shards(rows, self.folder(write), compact)

    def _files(self, writes: Iterable[int]) -> DataFrame:
        """The rows of these folders; no others are listed."""
        paths = [self.folder(w) for w in writes]
        rows = self._spark.read.schema(STORED_SCHEMA).option("basePath", f"{self.path}/embeddings")
        return rows.parquet(*paths) if paths else self._spark.createDataFrame([], STORED_SCHEMA)

    def _hide(self, write: int, batches: list[dict], place: float, ids: DataFrame | None = None) -> dict[int, bool]:
        """Note the ids that the new folder and these batches share: hidden in the batch that
        comes first. Returns the folders in which something is hidden. ``ids``: the folder's
        ids, which are read from it otherwise."""
        if not batches:
            return {}
        later = [b["write"] for b in batches if b["place"] > place]
        mine = (self._files([write]) if ids is None else ids).select("paragraph_id")
        others = self._files(b["write"] for b in batches).select("paragraph_id", "batch_no")
        of = F.when(F.col("batch_no").isin(later), F.lit(write)).otherwise(F.col("batch_no")).alias("of")
        shared = others.join(mine, "paragraph_id").select("paragraph_id", of).distinct()
        folder = f"{self.path}/hidden/by={write}"
        shared.write.mode("append").partitionBy("of").parquet(folder)
        # One row for each batch that lives.
        touched = self._spark.read.schema(HIDDEN).parquet(folder).select("of").distinct().collect()
        return {r.of: True for r in touched}

    def commit(
        self,
        write: int,
        writer: str = "",
        epoch: int | None = None,
        number: int | None = None,
        instead: tuple[dict, list[int]] | None = None,
        ids: DataFrame | None = None,
    ) -> VectorTable:
        """Make a written folder the store's newest batch, or put it in the place of the batch
        that the writer wrote for this number or epoch before. ``instead``: a state of the
        store and the shards of its batches that the folder replaces; it comes right after
        them, before batches that were added meanwhile. ``ids``: the folder's distinct ids, if
        the caller has them."""
        if self.dim is None:
            row = self._files([write]).select(dims("embedding").alias("dim")).first()
            self.dim = row.dim if row else None
        number = write if number is None else number
        compared: set[int] = set()
        touched: set[int] = set()
        while True:
            state = self.state()
            old = self._own(state, writer, epoch, number)
            if writer == CREATOR and state["version"] >= 0:
                raise ValueError(f"there is a store under {self.path} already")
            gone = {b["write"] for b in old}
            batches = [b for b in state["batches"] if b["write"] not in gone]
            place = old[0]["place"] if old else state["version"] + 1
            if instead:
                place = instead[0]["version"] + 0.5
            fresh = [b for b in batches if b["write"] not in compared]
            touched |= self._hide(write, fresh, place, ids).keys()
            compared |= {b["write"] for b in fresh}
            hidden = [
                {**b, "by": [w for w in b["by"] if w not in gone] + [write] * (b["write"] in touched)} for b in batches
            ]
            if instead:
                earlier = {b["write"] for b in instead[0]["batches"]}
                for b in hidden:
                    if b["write"] in earlier:
                        b["without"] = sorted({*b.get("without", []), *instead[1]})
            own = [write] if write in touched else []
            mine = {"write": write, "number": number, "place": place, "writer": writer, "epoch": epoch, "tier": 0}
            after = {
                "num_shards": self.num_shards,
                "dim": self.dim,
                "changes": state["changes"] + 1,
                "merged": state.get("merged", {}),
                "batches": sorted([*hidden, {**mine, "by": own}], key=lambda b: b["place"]),
            }
            if self.log.publish(state["version"] + 1, after):
                return self

    def _own(self, state: dict, writer: str, epoch: int | None, number: int) -> list[dict]:
        """The batch that this one replaces, if there is one; another writer's is refused."""
        if epoch is not None:
            if epoch <= state.get("merged", {}).get(writer, -1):
                raise ValueError(f"epoch {epoch} of {writer} is merged with others already")
            return [b for b in state["batches"] if b["writer"] == writer and b["epoch"] == epoch]
        same = [b for b in state["batches"] if b["number"] == number]
        if any(b["writer"] != writer for b in same):
            raise ValueError(f"batch {number} of {self.path} belongs to another writer")
        return same

    def stored(self) -> DataFrame:
        """Every row of the store's batches, superseded ones included. Folders of batches that
        were never logged, or shards that were replaced, are not read."""
        return self._rows(self.state()["batches"])

    def _rows(self, batches: list[dict]) -> DataFrame:
        groups: dict[tuple, list[int]] = {}
        for b in batches:
            groups.setdefault(tuple(b.get("without", ())), []).append(b["write"])
        parts = [
            self._files(writes).where(~F.col(SHARD_COLUMN).isin(*without)) if without else self._files(writes)
            for without, writes in groups.items()
        ]
        return unite(parts) if parts else self._files([])

    def last_batch(self) -> int:
        """The highest batch number written."""
        return max(b["number"] for b in self.state()["batches"])

    def vectors(self, version: int | None = None) -> DataFrame:
        """The current rows, the newest of each id; or those of an earlier version of the log."""
        return self._current(self.state(version)["batches"]).select(*VECTOR_COLUMNS, SHARD_COLUMN)

    def _current(self, batches: list[dict]) -> DataFrame:
        whole = self._rows([b for b in batches if not b["by"]])
        pairs = [(by, b["write"]) for b in batches for by in b["by"]]
        if not pairs:
            return whole
        paths = [f"{self.path}/hidden/by={by}/of={of}" for by, of in pairs]
        reader = self._spark.read.schema(HIDDEN).option("basePath", f"{self.path}/hidden")
        hidden = reader.parquet(*paths).select("paragraph_id", F.col("of").alias("batch_no"))
        rest = self._rows([b for b in batches if b["by"]])
        return whole.unionByName(rest.join(hidden, ["paragraph_id", "batch_no"], "left_anti").select(*whole.columns))

    def add_batch(
        self,
        batch: DataFrame,
        batch_no: int | None = None,
        order: str | None = None,
        writer: str = "",
        epoch: int | None = None,
        ids: DataFrame | None = None,
    ) -> VectorTable:
        """Add rows; an id already stored is replaced. ``order`` names a column that
        ranks repeats of an id within the batch; a caller who has settled them gives the
        distinct ``ids``, and no vector is moved to compare them, nor is the batch read again
        for its ids.

        ``writer`` and ``epoch`` name a batch for a writer that may run it again, such as a
        stream: the batch it wrote for that epoch is replaced, wherever it stands. A number that
        was merged with others is added anew; such an epoch is refused.
        """
        state = self.state()
        old = self._own(state, writer, epoch, batch_no) if epoch is not None or batch_no is not None else []
        write = self.log.claim(max((b["write"] for b in state["batches"]), default=-1) + 1)
        self._write(checked(newest(batch, order) if ids is None else batch, self.dim), write)
        self.commit(write, writer, epoch, old[0]["number"] if old else batch_no, ids=ids)
        return self.merge_small()

    def replace_shards(self, vectors: DataFrame, shards: Iterable[int], writer: str = "") -> VectorTable:
        """Put these vectors in place of all that the named shards hold now, as when a part of
        the store is embedded again. A vector of another shard fails the write. The other
        shards' files stay as they are, and so do batches that are added meanwhile; earlier
        versions still read the old vectors."""
        state, chosen = self.state(), sorted(set(shards))
        if not chosen or min(chosen) < 0 or max(chosen) >= self.num_shards:
            raise ValueError(f"shards must be between 0 and {self.num_shards - 1}, got {chosen}")
        write = self.log.claim(max((b["write"] for b in state["batches"]), default=-1) + 1)
        rows = checked(one_per_id(vectors.select(*VECTOR_COLUMNS)), self.dim)
        outside = ~shard_of("article_id", self.num_shards).isin(chosen)
        refused = F.raise_error(F.concat(F.lit("not in the shards to replace: "), "paragraph_id"))
        rows = rows.withColumn("embedding", F.when(outside, refused).otherwise(F.col("embedding")))
        self._write(rows, write)
        return self.commit(write, writer, instead=(state, chosen))

    def merge_small(self) -> VectorTable:
        """Put FANOUT neighbours of one tier into one batch of the next, without the rows that
        were replaced. The newest epoch of a writer stays by itself, as it may be run again. If
        another writer was first, nothing changes; a later add merges."""
        state = self.state()
        run = self._mergeable(state["batches"])
        if not run:
            return self
        write = self.log.claim(max(b["write"] for b in state["batches"]) + 1)
        write_shards(self._current(run).select(*VECTOR_COLUMNS, SHARD_COLUMN), self.folder(write))
        merged = dict(state.get("merged", {}))
        for b in run:
            if b["epoch"] is not None:
                merged[b["writer"]] = max(b["epoch"], merged.get(b["writer"], -1))
        last = run[-1]
        one = {**last, "write": write, "writer": "", "epoch": None, "tier": last["tier"] + 1, "by": [], "without": []}
        writes = {b["write"] for b in run}
        batches = [b for b in state["batches"] if b["write"] not in writes] + [one]
        after = {**state, "merged": merged, "batches": sorted(batches, key=lambda b: b["place"])}
        after.pop("version")
        self.log.publish(state["version"] + 1, after)
        return self

    @staticmethod
    def _mergeable(batches: list[dict]) -> list[dict]:
        last: dict[str, int] = {}
        for b in batches:
            if b["epoch"] is not None:
                last[b["writer"]] = max(b["epoch"], last.get(b["writer"], -1))
        run: list[dict] = []
        for b in batches:
            alone = b["writer"] == CREATOR or b["epoch"] is not None and b["epoch"] == last[b["writer"]]
            if alone or run and b["tier"] != run[0]["tier"]:
                run = []
            if not alone:
                run.append(b)
            if len(run) == FANOUT:
                return run
        return []

    def compact(self, path: str) -> VectorTable:
        """The current rows as a new single-batch store."""
        return VectorTable.create(self.vectors(), path, self.num_shards, self.dim)

    def shards(self) -> DataFrame:
        """The shards that hold data; none at all is an error."""
        found = self.stored().select(SHARD_COLUMN).distinct()
        if found.isEmpty():
            raise ValueError(f"no shards under {self.path}")
        return found

    def empty_shards(self) -> DataFrame:
        every = self._spark.range(self.num_shards).select(F.col("id").cast("int").alias(SHARD_COLUMN))
        return every.join(self.stored().select(SHARD_COLUMN).distinct(), SHARD_COLUMN, "left_anti")

    def shard(self, number: int) -> DataFrame:
        """One shard's current vectors; only its folders are read. A shard without data
        has no rows."""
        return self.vectors().where(F.col(SHARD_COLUMN) == number)

    def check_dims(self) -> int:
        """The common dimension of all vectors; uneven ones are an error."""
        low, high = self.vectors().agg(F.min(dims("embedding")), F.max(dims("embedding"))).first()
        if low != high:
            raise ValueError(f"vectors have between {low} and {high} dimensions")
        return low

    def sample_queries(self, count: int = 10) -> DataFrame:
        """The first ``count`` vectors, by id, of the lowest shard that holds data."""
        # A constant, so that only this shard's folders are read.
        lowest = self.stored().agg(F.min(SHARD_COLUMN)).first()[0]
        return (
            self.vectors()
            .where(F.col(SHARD_COLUMN) == F.lit(lowest))
            .orderBy("paragraph_id")
            .limit(count)
            .select("paragraph_id", "embedding")
        )

    def write_id_map(self, path: str, check: bool = True) -> DataFrame:
        """Export the id map; two ids with one numeric id are refused."""
        rows = self.vectors()
        if check:
            refuse_collisions(rows.select("paragraph_id"))
        id_map(rows).write.mode("overwrite").parquet(path)
        return self._spark.read.parquet(path)

    def corpus(self) -> DataFrame:
        """The current vectors under the names the search operators use."""
        return self.vectors().withColumnRenamed("paragraph_id", "id")

    def build_flat(self) -> VectorTable:
        """Write the current rows with packed vectors, for exact search."""
        folder = self._new_folder("flat")
        packed(self.corpus()).write.partitionBy(SHARD_COLUMN).parquet(f"{folder}/vectors")
        return self._note_index("flat", folder)

    def build_lsh(self, tables: int = 8, bits: int = 6) -> VectorTable:
        """Write the hyperplane index of the current rows."""
        folder = self._new_folder("lsh")
        approx.write_hyperplane_index(self.corpus(), folder, self.dim, tables, bits)
        return self._note_index("lsh", folder)

    def build_bounded(self, num_cells: int = 16, centres: np.ndarray | None = None, share: float = 1.0) -> VectorTable:
        """Write the current rows in blocks with bounds, around given or fitted centres, for
        exact search that leaves blocks out."""
        corpus = self.corpus()
        folder = self._new_folder("bounded")
        if centres is None:
            centres = approx.fit_centres(corpus, num_cells, share=share)
        bounded.write_bounded(corpus, folder, centres)
        return self._note_index("bounded", folder)

    def build_postings(self, tables: int = 8, bits: int = 8) -> VectorTable:
        """Write the current rows with the postings of their hyperplane buckets."""
        folder = self._new_folder("postings")
        postings.write_postings(self.corpus(), folder, self.dim, tables, bits)
        return self._note_index("postings", folder)

    def build_ivf(
        self, num_cells: int = 16, centres: np.ndarray | None = None, share: float = 1.0
    ) -> VectorTable:
        """Write the cluster index of the current rows, around given centres or around
        ``num_cells`` ones fitted on all rows, or on the ``share`` of them asked for; the
        share is noted in the index's settings."""
        corpus = self.corpus()
        folder = self._new_folder("ivf")
        if centres is None:
            centres = approx.fit_centres(corpus, num_cells, share=share)
            approx.write_cluster_index(corpus, folder, centres, share)
        else:
            approx.write_cluster_index(corpus, folder, centres)
        return self._note_index("ivf", folder)

    def _new_folder(self, kind: str) -> str:
        return f"{self.path}/{kind}/{uuid.uuid4().hex}"

    def _note_index(self, kind: str, folder: str) -> VectorTable:
        """The switch to a finished build: readers see it whole from here on."""
        covered = [(self.state()["changes"], folder, time.time())]
        self._spark.createDataFrame(covered, "writes long, folder string, built double").write.mode(
            "append"
        ).parquet(f"{self.path}/{kind}/covers")
        return self

    def _index(self, kind: str) -> tuple[str, str | None]:
        """The state of the newest build and its folder."""
        try:
            newest_build = self._spark.read.parquet(f"{self.path}/{kind}/covers")
            made = newest_build.orderBy(F.desc("built")).first()
        except AnalysisException:
            return "has not been built", None
        ready = made.writes == self.state()["changes"]
        return "ready" if ready else "is older than the store", made.folder

    def _exact_corpus(self) -> DataFrame:
        """The flat index while it covers the store, else the stored rows themselves."""
        state, folder = self._index("flat")
        if state != "ready":
            return self.corpus()
        return self._spark.read.parquet(f"{folder}/vectors")

    def search(
        self,
        queries: DataFrame,
        k: int,
        *,
        method: str = "exact",
        metric: str = "ip",
        exclude_self: bool = False,
        probes: int = 4,
    ) -> DataFrame:
        """Top-k per query. ``method``: ``exact``; ``sharded`` (per shard, then merged;
        the same rows); ``bounded`` (exact, without the blocks that cannot hold a hit, from a
        built index); ``lsh``, ``ivf`` or ``postings`` (approximate, from a built index)."""
        common = {"metric": metric, "carry": CARRY, "exclude_self": exclude_self}
        if method == "exact":
            return exact_top_k(queries, self._exact_corpus(), k, **common)
        if method == "sharded":
            hits = exact_top_k(queries, self._exact_corpus(), k, by=SHARD_COLUMN, **common)
            return hits.drop(SHARD_COLUMN)
        if method in (*APPROXIMATE, "bounded"):
            state, path = self._index(method)
            if state != "ready":
                raise ValueError(f"the {method} index {state}; build it first")
            if method == "lsh":
                return approx.search_hyperplane_index(queries, path, k, **common)
            if method == "bounded":
                return bounded.search_bounded(queries, path, k, **common)
            if method == "postings":
                return postings.search_postings(queries, path, k, probes, **common)
            return approx.search_cluster_index(queries, path, k, probes, **common)
        raise ValueError(f"unknown search method {method!r}")
