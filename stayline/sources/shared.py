"""The folder that all executors share."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


# Folders of local applications without the setting, by application id.
_local: dict[str, str] = {}

# Folders that the innermost open job has written for its own use.
_scratch: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A local application without that setting gets a temporary folder; on a
    cluster the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="stayline-")
    return _local[app]


def new_folder(spark: SparkSession) -> str:
    """A path below the shared folder that nobody uses yet."""
    return f"{shared_folder(spark)}/{uuid4().hex}"


#: Parquet settings for rows of megabytes: small row groups, sizes looked at after each row.
LARGE_ROWS = {
    "parquet.block.size": 8 << 20, "parquet.block.size.row.check.min": 1, "parquet.block.size.row.check.max": 1,
    "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1,
}


def saved(frame: DataFrame, large_rows: bool = False) -> DataFrame:
    """A reduced frame, written once and read back.

    For results that are used several times and are far smaller than what they
    were computed from; a lost executor does not lose them.  A reader holds a row group
    at least, which ``large_rows`` keeps to a few megabytes or one row.
    """
    path = new_folder(frame.sparkSession)
    if _scratch:
        _scratch[-1].append(path)
    frame.write.options(**(LARGE_ROWS if large_rows else {})).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system it is on."""
    files, folder = _file_system(spark, path)
    files.delete(folder, True)


def file_names(spark: SparkSession, path: str) -> set[str]:
    """Names of the files in a folder, none when it does not exist."""
    files, folder = _file_system(spark, path)
    if not files.exists(folder):
        return set()
    return {x.getPath().getName() for x in files.listStatus(folder)}


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is :func:`saved` within a job is removed at its end.

    The job must have written its results elsewhere by then.
    """
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            remove(spark, path)


def ensure_checkpoints(spark: SparkSession) -> None:
    """Point RDD checkpoints, which long boosting runs need, at the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
