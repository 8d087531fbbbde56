"""Plain files in the shared folder, written and read inside tasks.

A task writes under a name of its own and hands the name on as a row, so what a lost or
repeated attempt leaves behind is in no row and is never read.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


class Folder:
    """A folder by path or URI, on any file system that pyarrow knows."""

    def __init__(self, path: str):
        self.path = path

    def _at(self, name: str) -> tuple[fs.FileSystem, str]:
        system, base = fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), self.path)
        return system, f"{base}/{name}"

    def new_name(self, start: str, end: str) -> str:
        return f"{start}-{uuid.uuid4().hex}{end}"

    def create(self, name: str):
        system, path = self._at(name)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        return system.open_output_stream(path, compression=None)

    def open(self, name: str):
        """For reading at any place."""
        system, path = self._at(name)
        return system.open_input_file(path)
