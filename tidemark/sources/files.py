"""File systems as tasks see them."""

from __future__ import annotations

import pyarrow.fs as pafs


def open_filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and name in it, for a path as Spark reports it or a plain absolute path."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    return pafs.FileSystem.from_uri(path)
