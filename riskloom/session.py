"""Session settings, the shared scratch folder and staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from math import ceil

from pyspark.sql import DataFrame, SparkSession

PARTITION_MB = 128

_scope: ContextVar[str | None] = ContextVar("riskloom_scratch", default=None)
_local_folders: dict[str, str] = {}
_proven: dict[tuple[str, str], bool] = {}


def build_session(
    app_name: str = "riskloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    shuffle_gb: float | None = None,
    **conf: str,
) -> SparkSession:
    """A session with adaptive execution, UTC time and skew handling on.

    Give the size of the largest expected shuffle as ``shuffle_gb`` and it
    starts with partitions of the advisory size; adaptive execution merges those
    that turn out small. Spark's own default would put 100 TB into 200 of them.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", f"{PARTITION_MB}m")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_gb:
        shuffle_partitions = max(200, ceil(shuffle_gb * 1024 / PARTITION_MB))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _on_one_machine(spark: SparkSession) -> bool:
    """Whether the session's tasks run in the driver itself; ``local-cluster`` has executors of its own."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def _reaches_all(spark: SparkSession, folder: str) -> bool:
    """Whether rows that the executors there are now write below ``folder`` are all there when read again."""
    path = f"{folder}/riskloom/probe-{uuid.uuid4().hex}"
    tasks = 2 * max(2, spark.sparkContext.defaultParallelism)
    try:
        spark.range(0, tasks, 1, tasks).write.parquet(path)
        return spark.read.schema("id bigint").parquet(path).count() == tasks
    finally:
        _delete(spark, path)


def _is_shared(spark: SparkSession, folder: str) -> bool:
    """Whether all machines reach ``folder``; one of a machine's own file system has to prove it, once a session."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() != "file":
        return True
    key = spark.sparkContext.applicationId, folder
    if key not in _proven:
        try:
            _proven[key] = _reaches_all(spark, folder)
        except Exception as failed:
            # Without the folder, or with part of the files only, writers fail in many ways.
            raise RuntimeError(f"{folder} is a folder of one machine, or cannot be written: {failed}") from failed
    return _proven[key]


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, else the context's checkpoint
    folder, else one in the warehouse.

    Only a session whose tasks run in the driver gets a temporary folder where none is
    named. On a cluster a path of the machines' own file system is tried first: it is
    refused if rows that executors write there are not all read again. That shows what the executors
    there are at the time reach; ``spark.riskloom.sharedMount`` says that all machines mount it.
    """
    alone = _on_one_machine(spark)
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        mounted = spark.conf.get("spark.riskloom.sharedMount", "false") == "true"
        # Executors of a local-cluster share the machine's file system with the driver.
        if not (alone or mounted or spark.sparkContext.master.startswith("local")) and not _is_shared(spark, named):
            raise RuntimeError("spark.checkpoint.dir is a folder of one machine")
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if alone:
        if app not in _local_folders:
            _local_folders[app] = "file:" + tempfile.mkdtemp(prefix="riskloom-")
        return _local_folders[app]
    # Tables are written by all executors there, so both have to be shared.
    set_ = spark._jsc.sc().getCheckpointDir()
    folder = set_.get() if set_.isDefined() else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/riskloom-scratch"
    if not _is_shared(spark, folder):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return folder.rstrip("/")


def _app_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/riskloom/{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path not used before, under the current scratch scope."""
    return f"{_scope.get() or _app_folder(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Stage inside one folder and delete that folder on leaving.

    For jobs whose results are written out before the scope ends.
    """
    folder = scratch_path(spark, "scope")
    token = _scope.set(folder)
    try:
        yield folder
    finally:
        _scope.reset(token)
        _delete(spark, folder)


def drop_scratch(spark: SparkSession) -> None:
    """Delete all this application has staged; its staged frames end with it."""
    _delete(spark, _app_folder(spark))


def stage(df: DataFrame, label: str, **options: str | int) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    What follows sees fixed values, a short lineage that outlives lost
    executors, a prunable columnar scan, and a true size on disk, so that the
    optimizer's own size check decides whether a join side is broadcast. ``options``
    are the writer's.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
