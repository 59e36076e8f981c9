"""Files that tasks write to and read from the cluster's shared folder, through Arrow file systems."""

from __future__ import annotations

import contextlib
import os
import uuid
from collections.abc import Iterator

from pyarrow import fs
from pyspark import TaskContext


def open_folder(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder named by URI or absolute path; the folder exists afterwards."""
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    return system, path


def attempt_name(prefix: str) -> str:
    """A file name that no other attempt of this task uses; a manifest names those of the attempts that counted."""
    return f"{prefix}-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def reading(folder: str, name: str) -> Iterator:
    """A file of the folder open for random access; mapped into memory where it is a local one."""
    system, path = fs.FileSystem.from_uri(folder)
    if isinstance(system, fs.LocalFileSystem):
        import pyarrow as pa

        with pa.memory_map(os.path.join(path, name)) as file:
            yield file
    else:
        with system.open_input_file(f"{path}/{name}") as file:
            yield file
