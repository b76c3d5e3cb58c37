"""Files that tasks write below a folder which all machines share.

A task writes under a name of its own attempt and returns it; only names that a
finished task has returned are ever read, so a task that runs twice or is lost
leaves a file that nobody refers to.
"""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark import TaskContext


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it; a path without a scheme is a local (mounted) one."""
    return fs.FileSystem.from_uri(uri if ":/" in uri else f"file://{uri}")


def attempt_name(prefix: str, suffix: str) -> tuple[int, str]:
    """The partition of the running task and a file name that no other attempt uses."""
    part = TaskContext.get().partitionId()
    return part, f"{prefix}-{part:05d}-{uuid.uuid4().hex}{suffix}"
