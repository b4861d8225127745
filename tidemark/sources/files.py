"""Files opened by tasks themselves, through ``pyarrow.fs``."""

from __future__ import annotations


def file_opener():
    """For tasks: the ``pyarrow.fs`` file system of a path as Spark lists it, and the path in it."""
    def opened(path):
        from pyarrow import fs

        scheme, colon, rest = path.partition(":")
        if not colon or "/" in scheme:
            return fs.LocalFileSystem(), path
        if scheme == "file":
            return fs.LocalFileSystem(), "/" + rest.lstrip("/")
        return fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + colon + rest)

    return opened
