"""Binary files that tasks write to the shared folder and that Spark reads back.

A file has a name that its content decides (its part number). A task writes under
a name of its own and renames at the end, so a task that runs again, after the loss
of an executor or speculatively, leaves one whole file with the same bytes.
"""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path of a qualified URI; Spark's names of an object store are those of pyarrow."""
    scheme = folder.partition("://")[0] if "://" in folder else ""
    if not scheme:
        raise ValueError(f"not a qualified folder: {folder}")
    if scheme in ("s3a", "s3n"):
        folder = "s3" + folder[len(scheme) :]
    return fs.FileSystem.from_uri(folder)


def write_file(folder: str, name: str, content: bytes) -> None:
    """Write ``content`` as ``folder/name``; ``folder`` is a URI that ``common.qualified`` gave, the same one that Spark reads."""
    system, path = opened(folder)
    system.create_dir(path, recursive=True)
    own = f"{path}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(own) as out:
        out.write(content)
    system.move(own, f"{path}/{name}")


def read_files(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """``name`` and ``content`` of the folder's files; Spark finds and reads them. No folder, no rows."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(folder)
    return found.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
