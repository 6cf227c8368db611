"""Files that tasks write to and read from the shared folders, besides Spark's own readers."""

from __future__ import annotations

import re

from pyarrow import fs


def shared(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or absolute path, and the path in it."""
    return fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", uri))


def size_of(uri: str) -> int:
    files, path = shared(uri)
    return files.get_file_info(path).size
