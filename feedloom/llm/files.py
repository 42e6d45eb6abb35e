"""Opening shared files from Python tasks, on whatever filesystem the path names."""

from __future__ import annotations

# Hadoop scheme -> scheme pyarrow knows (fixed values).
_SCHEMES = {"s3a": "s3", "s3n": "s3", "file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "gs": "gs"}


def filesystem(path: str):
    """(pyarrow filesystem, path inside it) of a path or URI."""
    import pyarrow.fs as pafs

    scheme, sep, rest = path.partition(":")
    if not sep or "/" in scheme:
        return pafs.LocalFileSystem(), path
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pafs.FileSystem.from_uri(_SCHEMES.get(scheme, scheme) + ":" + rest)
