"""Where jobs put data that must outlive a task: checkpoints, landings, state tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
#: A session's own folder where the cluster names none; the setting above cannot be changed in a session.
OWN_SETTING = "spark.tickloom.shared.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir.

    Only a local master may go without the setting and gets a temporary folder: on a
    cluster a machine-local folder would be lost with its executor.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.conf.get(OWN_SETTING, None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):  # local-cluster has executors
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="tickloom-")
    spark.conf.set(OWN_SETTING, folder)
    return folder


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path of its own below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def _hadoop_path(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    location = hadoop.Path(path)
    return location, location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a path; empty when the path is missing."""
    location, files = _hadoop_path(spark, path)
    if not files.exists(location):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(location) if s.isDirectory())


def delete_folder(spark: SparkSession, path: str) -> None:
    location, files = _hadoop_path(spark, path)
    files.delete(location, True)


def is_complete(spark: SparkSession, path: str) -> bool:
    """True once a job has finished writing the folder."""
    location, files = _hadoop_path(spark, f"{path}/_SUCCESS")
    return files.exists(location)


def files_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly below a path; empty when the path is missing."""
    location, files = _hadoop_path(spark, path)
    if not files.exists(location):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(location) if s.isFile())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write one small file that is there as a whole or not at all; an existing one stays."""
    location, files = _hadoop_path(spark, path)
    if files.exists(location):
        return
    draft = location.suffix(f".{uuid.uuid4().hex}.draft")
    out = files.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not files.rename(draft, location) and not files.exists(location):
        raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    location, files = _hadoop_path(spark, path)
    source = files.open(location)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()
