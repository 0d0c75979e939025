"""Files that tasks read and write as byte streams."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.fs  # noqa: F401  (makes pa.fs available)


def filesystem(path: str) -> tuple[pa.fs.FileSystem, str]:
    """File system of a path or URI, and the path on it."""
    if path.startswith("s3a://"):
        path = "s3://" + path.removeprefix("s3a://")
    if "://" in path and not path.startswith("file:"):
        return pa.fs.FileSystem.from_uri(path)
    return pa.fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
