"""Small file helpers for tasks that store whole objects."""

from __future__ import annotations

import posixpath
import re

from pyarrow import fs


def open_folder(root: str):
    """The file system and plain path of a folder given as a path or URI."""
    if re.match(r"^[A-Za-z0-9+.-]+:/", root):
        uri = re.sub(r"^s3[an]:", "s3:", root)
        uri = re.sub(r"^file:/+", "file:///", uri)
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), root


class PendingObject:
    """An object being written; it gets its real name when it is complete."""

    def __init__(self, root: str, key: str, attempt: int) -> None:
        self.key = key
        self._files, folder = open_folder(root)
        self._final = posixpath.join(folder, key)
        self._pending = f"{self._final}.{attempt}.partial"
        self._files.create_dir(posixpath.dirname(self._final), recursive=True)
        self._stream = self._files.open_output_stream(self._pending)

    def write(self, data) -> None:
        self._stream.write(data)

    def publish(self) -> int:
        """Give the object its name and return the size the store reports for it."""
        self._stream.close()
        self._files.move(self._pending, self._final)
        return self._files.get_file_info(self._final).size

    def abandon(self) -> None:
        self._stream.close()
