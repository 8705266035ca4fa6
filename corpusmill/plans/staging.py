"""Written intermediate tables and size-checked broadcasts."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows a table may have before a join stops asking for a broadcast. The tables
# checked here have short fixed-width rows, so this is well under 1 GB.
BROADCAST_ROW_LIMIT = 2_000_000


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="corpusmill-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its scheme, so that Spark and plain file access mean the same place."""
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
    if "://" in path or path.startswith("file:") or default.startswith("file:"):
        return path
    return default.rstrip("/") + path


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call gets."""
    path = f"{qualified(spark, shared_folder(spark))}/corpusmill/{name}-{uuid4().hex}"
    if _scratch:
        _scratch[-1].append(path)
    return path


# Paths handed out inside the open scratch blocks, innermost last.
_scratch: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are removed at the end: nothing made of them may be read later."""
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, with the settings Spark itself reads and writes it with."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back: lineage ends here and the size is known.

    A lost executor costs a re-read of the written files, nothing upstream.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(staged: DataFrame, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Ask for a broadcast only when a staged table is counted to be small.

    The count reads parquet footers only. Larger tables are left to the
    optimizer, which then joins by shuffle.
    """
    return F.broadcast(staged) if staged.count() <= limit else staged
