"""Binary files in the shared folder, written and read by tasks."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyarrow import fs


def _system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it; Hadoop writes ``file:/x`` for ``file:///x``."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


def create(folder: str, name: str) -> tuple[str, pa.NativeFile]:
    """A new file that no other attempt of the same task writes; only its rows name it."""
    system, base = _system(folder)
    system.create_dir(base, recursive=True)
    leaf = f"{name}-{uuid.uuid4().hex}"
    return f"{folder}/{leaf}", system.open_output_stream(f"{base}/{leaf}")


class Reader:
    """Ranges of files; the file read last stays open."""

    def __init__(self):
        self.path, self.file = None, None

    def read(self, path: str, offset: int, length: int) -> bytes:
        if path != self.path:
            if self.file:
                self.file.close()
            system, base = _system(path)
            self.path, self.file = path, system.open_input_file(base)
        return self.file.read_at(length, offset)
