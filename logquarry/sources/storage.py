"""Reading byte ranges of stored files inside tasks, on any file system Arrow can open."""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


_SYSTEMS: dict = {}  # of this worker, by authority


def resolve(path: str):
    """File system and path on it. Paths stay as Spark lists them: ``%`` and blanks are literal."""
    from pyarrow import fs

    scheme, mark, rest = path.partition("://")
    if not mark or scheme == "file":
        local = path.removeprefix("file:")
        return fs.LocalFileSystem(), "/" + local.lstrip("/")
    authority, _, key = rest.partition("/")
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    if (scheme, authority) not in _SYSTEMS:
        _SYSTEMS[scheme, authority] = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    system, base = _SYSTEMS[scheme, authority]
    return system, f"{base.rstrip('/')}/{key}"


def list_folder(path: str):
    """(path, kind, length, modification time) of each entry, or of the file itself. Paths have the form of the given
    one; the kind is file, folder, or link: a link to a folder."""
    import os

    from pyarrow import fs

    system, location = resolve(path)
    start = path.removesuffix(location) if path.endswith(location) else f"{path[: len(path) - len(location.lstrip('/'))]}"
    own = system.get_file_info(location.rstrip("/") or "/")
    if own.type == fs.FileType.NotFound:
        raise FileNotFoundError(f"{path} does not exist")
    local = isinstance(system, fs.LocalFileSystem)
    entries = [own] if own.type == fs.FileType.File else system.get_file_info(fs.FileSelector(own.path))
    for entry in entries:
        kind = "folder" if entry.type == fs.FileType.Directory else "file"
        if kind == "folder" and local and os.path.islink(entry.path):
            kind = "link"
        yield start + entry.path, kind, entry.size if kind == "file" else 0, entry.mtime


def open_file(path: str):
    """Random-access file."""
    system, location = resolve(path)
    return system.open_input_file(location)


def read_range(file, offset: int, size: int) -> bytes:
    file.seek(offset)
    return file.read(size)


class FileCursor:
    """Keeps the last file open: ranges of one file mostly follow each other."""

    def __init__(self):
        self.path, self.file = None, None

    def read(self, path: str, offset: int, size: int) -> bytes:
        if path != self.path:
            self.close()
            self.file, self.path = open_file(path), path
        return read_range(self.file, offset, size)

    def close(self):
        if self.file is not None:
            self.file.close()
        self.path = self.file = None


def repeat_rows(batch: pa.RecordBatch, rows: list[int]) -> list[pa.Array]:
    """The columns of ``batch``, each row as often as ``rows`` names it."""
    index = pa.array(rows, pa.int64())
    return [column.take(index) for column in batch.columns]
