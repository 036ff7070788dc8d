"""Files in the shared folder, written and read by tasks."""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

from headwater.session import scratch_dir


def new_folder(spark: SparkSession, label: str) -> str:
    """The URI of a new folder below the session's shared folder; a path without a scheme is on the default file system."""
    path = scratch_dir(spark, label)
    if "://" in path or path.startswith("file:"):
        return path
    return spark.conf.get("spark.hadoop.fs.defaultFS", "file://").rstrip("/") + path


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


def attempt_name(stem: str, suffix: str) -> str:
    """A name no other attempt of the task uses; only names that a finished task returns count."""
    return f"{stem}-{uuid.uuid4().hex[:12]}.{suffix}"


def delete_folder(uri: str) -> None:
    """Deletes a folder whose results are in written tables; one that no task made is none."""
    system, root = open_folder(uri)
    if system.get_file_info(root).type == fs.FileType.Directory:
        system.delete_dir(root)
