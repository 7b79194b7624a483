"""Session settings for jobs and tests, and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from py4j.protocol import Py4JJavaError
from pyspark import SparkContext
from pyspark.sql import SparkSession

# Settings every job of this package wants, on a laptop and on a cluster.
# AQE picks the join strategy from measured sizes, splits skewed join
# partitions, and coalesces the generous initial shuffle partition number.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

_TASK_BYTES = 128 << 20


def sized_for(shuffle_bytes: int) -> dict[str, str]:
    """Settings for jobs whose largest shuffle moves about ``shuffle_bytes``.

    Adaptive execution only ever joins shuffle partitions, so a shuffle starts
    with one for each 128 MB: some 800,000 for 100 TB, 20,000 for 2.5 TB. Files
    are written in that size, too.
    """
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(
            max(200, -(-shuffle_bytes // _TASK_BYTES))
        ),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(_TASK_BYTES),
    }


def build_session(app_name: str = "tillwright", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Return a session with ``JOB_CONF``; ``conf``, such as ``sized_for``, wins over it."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**JOB_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What a statement inside shuffles leaves the executors' disks as soon as it ends.

    Otherwise it stays until the driver's garbage collector finds its plan unused, so a job of
    many steps holds the shuffles of several at once. A lost task of the same statement
    still finds them, and a frame that is run a second time makes them anew.
    """
    before = spark.conf.get(FREED)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(FREED, before)


_SCRATCH: list[str] = []


def scratch_folder(spark: SparkSession, label: str) -> str:
    """Return a fresh, not yet existing folder all executors can reach.

    It lies under ``spark.checkpoint.dir``, or where that is unset under the
    warehouse, which a cluster shares as well. A warehouse on the disk of one machine
    is refused unless Spark runs on that machine alone.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        # Spark puts the scheme before it when the session starts.
        if warehouse.startswith("file:") and spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = warehouse + "/_scratch"
    folder = f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _SCRATCH.append(folder)
    return folder


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files_of(spark: SparkSession, where):
    return where.getFileSystem(spark._jsc.hadoopConfiguration())


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder or file that nothing reads any more."""
    where = _path(spark, path)
    _files_of(spark, where).delete(where, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all scratch folders this driver has made; call it when results are written."""
    while _SCRATCH:
        discard(spark, _SCRATCH.pop())


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none where it does not exist."""
    where = _path(spark, path)
    files = _files_of(spark, where)
    return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    where = _path(spark, path)
    stream = _files_of(spark, where).open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, which must not exist."""
    where = _path(spark, path)
    stream = _files_of(spark, where).create(where, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


@cache
def _renamer(context: SparkContext, root: str):
    """What renames files of one file system, and no options for it; slow to make."""
    hadoop = context._jvm.org.apache.hadoop.fs
    files = hadoop.FileContext.getFileContext(
        context._jvm.java.net.URI(root), context._jsc.hadoopConfiguration())
    return files, context._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)


def rename_new(spark: SparkSession, path: str, to: str) -> bool:
    """Rename a file or folder; False, and nothing done, if the new name is taken.

    One step on file systems that rename in one (HDFS and the like); on a plain object
    store a folder is copied file by file, and one writer at a time must be seen to.
    """
    old, new = _path(spark, path), _path(spark, to)
    files = _files_of(spark, new)
    files.mkdirs(new.getParent())
    if files.getUri().getScheme() == "file":
        # On a local disk the other way looks first, too, and starts a program for each name.
        return not files.exists(new) and files.rename(old, new)
    context, none = _renamer(spark.sparkContext, files.getUri().toString())
    try:
        context.rename(files.makeQualified(old), files.makeQualified(new), none)
    except Py4JJavaError as error:
        if files.exists(new):
            return False
        raise error
    return True
