"""Files that tasks write and read beside Spark's own sources.

The folder is one that every executor shares, under spark.checkpoint.dir. A
task writes under a name of its own and only what its committed rows name
is ever read, so a repeated or lost task leaves at most an unread file.
"""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark import TaskContext


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's URI (``file:``, ``hdfs:``, ``s3:`` ...)
    and the path there."""
    if uri.startswith("file:"):
        uri = "file:///" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def own_name(suffix: str) -> str:
    """A file name that no other attempt of any task uses."""
    return f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}{suffix}"
