"""Tables written once in the shared folder and read by several branches."""

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

FOLDER_SETTING = "spark.checkpoint.dir"
#: Shuffle files go when a write ends, not when the driver collects its garbage.
_CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Paths that the run around the present call has staged.
_staged: ContextVar[list | None] = ContextVar("staged", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names; a fresh one only in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get(FOLDER_SETTING, None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError(f"set {FOLDER_SETTING} to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="courtstats-"))
    return context.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, **options) -> DataFrame:
    """Write a table once and read it back.

    The file survives lost executors, later readers prune its columns, and the
    optimizer knows its size, so a small table is broadcast and a large one is
    not. ``options`` are those of the Parquet writer.
    """
    path = new_path(df.sparkSession, name)
    if _staged.get() is not None:
        _staged.get().append(path)
    with _shuffles_dropped(df.sparkSession):
        df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def _shuffles_dropped(spark: SparkSession):
    """Inside, what a write shuffled is deleted when it ends: its rows are in files."""
    before = spark.conf.get(_CLEANUP_SETTING, None)
    spark.conf.set(_CLEANUP_SETTING, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP_SETTING)
        else:
            spark.conf.set(_CLEANUP_SETTING, before)


@contextmanager
def run_owning_stages(spark: SparkSession):
    """Delete what is staged inside when the block ends; its result must be written."""
    mine = []
    token = _staged.set(mine)
    try:
        yield mine
    finally:
        _staged.reset(token)
        for path in mine:
            forget(spark, path)


def forget(spark: SparkSession, path: str) -> None:
    """Delete a staged table."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def stage_result(spark: SparkSession, make, name: str) -> tuple[DataFrame, str]:
    """The staged result of ``make()`` and its path; what was staged on the way goes."""
    with run_owning_stages(spark) as mine:
        found = stage(make(), name)
        path = mine.pop()
    return found, path
