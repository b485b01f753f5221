"""Binary files that tasks write into, and read from, the folder shared by the driver and all executors."""

from __future__ import annotations

import uuid

from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import SparkSession

from coverlay.operators.stage import checkpoint_dir


def new_folder(spark: SparkSession, name: str) -> str:
    """URI of a folder not used before, beside the session's checkpoints."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def open_new(folder: str, suffix: str):
    """``(uri, stream)`` of a new file. Each attempt of a task has its own file, so a retry never meets a half one;
    only files named in a job's committed output count."""
    task = TaskContext.get()
    uri = f"{folder}/{task.partitionId() if task else 0:06d}-{uuid.uuid4().hex}{suffix}"
    system, path = pafs.FileSystem.from_uri(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return uri, system.open_output_stream(path)


def open_old(uri: str):
    system, path = pafs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def size_of(uri: str) -> int:
    system, path = pafs.FileSystem.from_uri(uri)
    info = system.get_file_info(path)
    if info.type != pafs.FileType.File:
        raise FileNotFoundError(uri)
    return info.size
