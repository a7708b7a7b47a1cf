"""Task-side files on the shared storage: written under a temporary name, then renamed.

A task that is run again (lost executor, speculation) writes the same bytes under a new temporary
name and renames over the same final name, so readers only ever see whole files; the manifest that
Spark commits last says which files count.
"""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a folder URI (``file:/x``, ``hdfs://..``, ``s3://..`` or a path)."""
    if uri.startswith("file:"):
        uri = "file:///" + uri[len("file:"):].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


class AtomicFile:
    """A file that appears under ``name`` in ``folder`` only when closed by :meth:`commit`."""

    def __init__(self, folder: str, name: str):
        self.fs, self.path = filesystem(folder)
        self.name = name
        self.temporary = f"{self.path}/_temporary-{uuid.uuid4().hex}/{name}"
        self.fs.create_dir(self.temporary.rsplit("/", 1)[0], recursive=True)
        self.stream = self.fs.open_output_stream(self.temporary, compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def commit(self) -> None:
        self.stream.close()
        self.fs.move(self.temporary, f"{self.path}/{self.name}")
        self.fs.delete_dir(self.temporary.rsplit("/", 1)[0])
