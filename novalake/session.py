"""Session factory and the one place that decides where staged tables go."""

from __future__ import annotations

import tempfile
import uuid
import warnings
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

# Safe to set on any cluster: none of them depends on its size. Executor
# counts, memory and the shuffle partition number belong to the deployment.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def build_session(
    app_name: str = "novalake",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(ENGINE_CONF)
    conf["spark.scheduler.mode"] = "FAIR"  # tables built at the same time share the cores
    conf["spark.serializer"] = "org.apache.spark.serializer.KryoSerializer"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Puts a session built elsewhere on UTC: ``to_date(ts)`` and day partitions depend on it. For plans
    that the caller runs; jobs that run to their end use :func:`utc`."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    """A setting for the jobs inside; afterwards the caller's holds again."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def utc(spark: SparkSession):
    """UTC for the jobs inside; afterwards the caller's time zone holds again."""
    return _setting(spark, "spark.sql.session.timeZone", "UTC")


def tidy(spark: SparkSession):
    """Jobs inside delete their shuffle files when they end. Else these stay until the driver happens to collect its garbage: the
    shuffles of a run of many jobs would lie on the disks together."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


# Temporary folders of local sessions that name none.
_own_dirs: dict[str, str] = {}

# Of cluster sessions and the folders they may use: the first in which the driver has found what executors wrote.
_seen_shared: dict[tuple[str, ...], str] = {}
PROBE_TASKS = 64


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, else what ``setCheckpointDir`` was given, else
    one in the warehouse, where Spark itself has executors write managed tables.

    Only a local master may fall back to a temporary folder: executors of a cluster, and of ``local-cluster`` too, may
    have temporary folders of their own and could not read what another process wrote there. For the same reason
    a cluster passes over a folder, named or not, that turns out to be each machine's own.
    """
    app, master = spark.sparkContext.applicationId, spark.sparkContext.master
    named = spark.conf.get("spark.checkpoint.dir", None)
    if master == "local" or master.startswith("local["):
        if named:
            return named.rstrip("/")
        if app not in _own_dirs:
            _own_dirs[app] = "file://" + tempfile.mkdtemp(prefix="novalake-")
        return _own_dirs[app]
    warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
    given = [named, spark.sparkContext.getCheckpointDir(), warehouse and f"{warehouse.rstrip('/')}/novalake-staged"]
    folders = [folder.rstrip("/") for folder in given if folder]
    if (app, *folders) not in _seen_shared:
        _seen_shared[app, *folders] = _first_shared(spark, folders)
    return _seen_shared[app, *folders]


def _first_shared(spark: SparkSession, folders: list[str]) -> str:
    refused: list[Exception] = []
    for folder in folders:
        try:
            _require_shared(spark, folder)
        except (RuntimeError, PySparkException, Py4JJavaError) as error:
            refused.append(error)
            continue
        if refused:
            warnings.warn(f"tables are staged in {folder}: {refused[0]}")
        return folder
    raise refused[0]


def _require_shared(spark: SparkSession, folder: str) -> None:
    """Refuses a folder in which the driver does not find a file of each task: tables staged there would lack rows."""
    path = f"{folder}/probe-{uuid.uuid4().hex}"
    tasks = min(PROBE_TASKS, spark.sparkContext.defaultParallelism)
    try:
        spark.range(0, tasks, 1, tasks).write.parquet(path)
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(jvm_path)
        found = sum(status.getPath().getName().startswith("part-") for status in files)
    finally:
        drop_path(spark, path)
    if found < tasks:
        raise RuntimeError(f"{folder} is a folder of each machine's own: the driver finds {found} of {tasks} files there "
                           "that executors wrote; set spark.checkpoint.dir to a folder shared by all of them")


def new_stage_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, dropped when the driver JVM ends, or before by :func:`drop_path`."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(jvm_path)  # Hadoop notes only what exists, and drops what is there in the end
    fs.deleteOnExit(jvm_path)
    fs.delete(jvm_path, True)
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder made by :func:`new_stage_path`."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)
