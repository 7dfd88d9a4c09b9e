"""Files in the folder that driver and executors share, and columns taken from any table."""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.session import scratch_path, settle  # noqa: F401  (used by the operators)


def col(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col(f"`{name}`")


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: rows, and bytes of them, that are handed to a Python worker at a time
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20}


def bounded_batches(spark) -> None:
    """From now on Python workers get at most ``BATCH`` at a time, so what they hold does not go with the length of texts."""
    for name, most in BATCH.items():
        spark.conf.set(name, str(most))


def file_system(uri: str):
    """(file system, path) of a folder; anything Arrow can open: file, s3, gs, hdfs."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), re.sub("^file:/*", "/", uri)
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def write_once(uri: str, name: str, content: bytes, attempt: str) -> None:
    """Write under a temporary name, then rename: a reader sees the whole file or none."""
    files, folder = file_system(uri)
    temporary = f"{folder}/_temporary/{attempt}-{name}"
    files.create_dir(os.path.dirname(temporary), recursive=True)
    with files.open_output_stream(temporary) as out:
        out.write(content)
    files.move(temporary, f"{folder}/{name}")


def read_whole(uri: str, name: str) -> bytes:
    files, folder = file_system(uri)
    with files.open_input_stream(f"{folder}/{name}") as source:
        return source.read()


def task_names() -> tuple[int, str]:
    """Number of this task's partition, and a name no other attempt at it has."""
    from pyspark import TaskContext

    task = TaskContext.get()
    return task.partitionId(), f"{task.partitionId()}-{task.taskAttemptId()}"
