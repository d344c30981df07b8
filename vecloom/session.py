"""Session settings, the scratch folder and task sizing."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Rows per Arrow batch handed to Python. 8,192 rows of 384 floats are 12.6 MB, so a
# task holds a few such blocks at a time whatever the size of the table.
ARROW_BATCH_ROWS = 8192
TASKS_PER_CORE = 4
# The folders of run_dir since the innermost passing_scratch began.
_made: list[str] = []


def build_session(
    app: str = "vecloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **settings: str,
) -> SparkSession:
    """A session with the settings the library is tested under.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: the cluster names
    the first, and adaptive execution sizes the second from the data.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_BATCH_ROWS))
        # Long texts: a batch is also cut at this size.
        .config("spark.sql.execution.arrow.maxBytesPerBatch", "64m")
        # One BLAS thread per task: parallelism comes from Spark's tasks alone.
        .config("spark.executorEnv.OMP_NUM_THREADS", "1")
        .config("spark.executorEnv.OPENBLAS_NUM_THREADS", "1")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written intermediates: the one the cluster names in
    ``spark.checkpoint.dir``. Where all tasks run on this machine, a folder beside the tables
    of the warehouse will do; a cluster that names none is refused, as its executors may not
    see what the others write there."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/vecloom-scratch"


def run_dir(spark: SparkSession, label: str) -> str:
    """A new folder for one run; an earlier run's files are never written over.

    The application owns it: its file system removes all its folders when the driver ends.
    """
    context = spark.sparkContext
    own = f"{scratch_root(spark)}/{context.applicationId}"
    folder = context._jvm.org.apache.hadoop.fs.Path(own)
    system = folder.getFileSystem(context._jsc.hadoopConfiguration())
    if not system.exists(folder):
        system.mkdirs(folder)
        system.deleteOnExit(folder)
    _made.append(f"{own}/{label}-{uuid.uuid4().hex}")
    return _made[-1]


@contextlib.contextmanager
def passing_scratch(spark: SparkSession) -> Iterator[None]:
    """Folders made by :func:`run_dir` inside are removed at the end: for a step whose result is
    written elsewhere before it ends."""
    outer, _made[:] = list(_made), []
    try:
        yield
    finally:
        inner, _made[:] = list(_made), outer
        context = spark.sparkContext
        for path in inner:
            folder = context._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def settled(df: DataFrame, label: str, *folders: str) -> DataFrame:
    """The rows as a written table, for a result that several later steps read; in a folder for
    each value of the ``folders`` columns, which come last then.

    It is computed once, survives the loss of an executor, and gives the planner its
    real size, so Spark itself decides whether a join may broadcast it.
    """
    path = run_dir(df.sparkSession, label)
    writer = df.write.partitionBy(*folders) if folders else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame, key: str, tasks: int | None = None) -> DataFrame:
    """Give a scan of few files enough tasks for costly per-row work.

    A table of at least as many files as there are cores passes through without a
    shuffle; the file listing tells, no plan is made or run. ``tasks`` asks for so many in
    any case. ``key`` should be unique, so that the rows spread evenly and a retried task
    gets the same rows.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if tasks is None and len(scan.inputFiles()) >= cores:
        return scan
    return scan.repartition(tasks or cores * TASKS_PER_CORE, key)
