"""Raw files in the shared folder, for formats that Spark has no writer for.

Executors open them by the folder's own URI (a mounted path, s3, gs, hdfs).
A writer task picks a fresh name for every attempt and reports it in a row;
the rows are written as a Parquet table by Spark's own commit protocol, so a
file of a lost or repeated attempt is never referred to.
"""

from __future__ import annotations

import uuid

from pyarrow import fs as pafs


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and the path in it of a URI or of a plain absolute path."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


def new_file(folder: str, suffix: str) -> str:
    """A name that no other attempt uses; makes the folder where there are folders."""
    f, p = open_fs(folder)
    f.create_dir(p, recursive=True)
    return f"{folder}/{uuid.uuid4().hex}{suffix}"


def remove(uri: str) -> None:
    f, p = open_fs(uri)
    f.delete_file(p)
