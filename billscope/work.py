"""Work tables: results that several later steps read, written once to shared storage.

A work table cuts lineage, so losing an executor never repeats the scan behind it, and it gives Catalyst
the real size of the data, from which it picks broadcast or shuffle joins.
"""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession

#: Rows of numbers that a task writes at least, where all cores have work.
TASK_ROWS = 100_000

_job_folder: ContextVar[str | None] = ContextVar("job_folder", default=None)


@cache
def _private_dir() -> str:
    folder = tempfile.mkdtemp(prefix="billscope-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def work_dir(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir`` or set on the context.

    Only a local session without either gets a private one.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = _private_dir()
    return shared.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    home = _job_folder.get() or f"{work_dir(spark)}/billscope"
    return f"{home}/{name}-{uuid.uuid4().hex}"


@contextmanager
def job_folder(spark: SparkSession, job: str) -> Iterator[str]:
    """Keep the work tables made inside together in a folder, and delete them on the way out.

    For jobs that store their result. Frames handed to a caller still read their work tables.
    """
    folder = new_path(spark, job)
    token = _job_folder.set(folder)
    try:
        yield folder
    finally:
        _job_folder.reset(token)
        delete(spark, folder)


def file_system(spark: SparkSession, location: str):
    """The Hadoop file system of a location, and the location as its path."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def delete(spark: SparkSession, location: str) -> None:
    files, path = file_system(spark, location)
    files.delete(path, True)


def checkpoint(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` on shared storage; unlike a work table it keeps its partitions and their order."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_dir(df.sparkSession))
    return df.checkpoint()


def few(spark: SparkSession, rows: int) -> int:
    """Tasks for so many rows of a few numbers: one a core, or more of ``TASK_ROWS`` each."""
    return max(spark.sparkContext.defaultParallelism, math.ceil(rows / TASK_ROWS))


def in_few_files(df: DataFrame, rows: int) -> DataFrame:
    """``df``, which has about so many rows of a few numbers, written by a task a core, or more of ``TASK_ROWS`` each.

    For what comes from a shuffle: a file for each of its partitions costs far more than the rows do.
    """
    return df.coalesce(few(df.sparkSession, rows))


def materialise(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as a work table and return a frame that reads it; ``options`` are those of the parquet writer."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
