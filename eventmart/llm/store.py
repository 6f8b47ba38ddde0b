"""Files of a folder that driver and executors share, by plain path or URI."""

from __future__ import annotations

import os
import posixpath
from typing import BinaryIO
from urllib.parse import unquote, urlsplit

from pyarrow import fs as arrow_fs


class Folder:
    """A folder on a mounted file system (no scheme, or ``file:``), or on one that Arrow reaches."""

    def __init__(self, path: str) -> None:
        parts = urlsplit(path)
        if parts.scheme in ("", "file"):
            self.fs, self.root = arrow_fs.LocalFileSystem(), os.path.abspath(
                unquote(parts.path) if parts.scheme else path)
        else:
            self.fs, self.root = arrow_fs.FileSystem.from_uri(path)

    def at(self, name: str) -> str:
        return posixpath.join(self.root, name)

    def files(self, suffix: str) -> list[tuple[str, int]]:
        """Names and sizes of the files directly in the folder."""
        found = self.fs.get_file_info(arrow_fs.FileSelector(self.root, allow_not_found=True))
        return sorted((f.base_name, f.size) for f in found
                      if f.type == arrow_fs.FileType.File and f.base_name.endswith(suffix))

    def read(self, name: str) -> BinaryIO:
        return self.fs.open_input_file(self.at(name))

    def write(self, name: str) -> BinaryIO:
        self.fs.create_dir(posixpath.dirname(self.at(name)), recursive=True)
        return self.fs.open_output_stream(self.at(name), compression=None)

    def move(self, name: str, to: str) -> None:
        self.fs.move(self.at(name), self.at(to))

    def remove(self, name: str) -> None:
        """A folder below this one, if it is there."""
        if self.fs.get_file_info(self.at(name)).type == arrow_fs.FileType.Directory:
            self.fs.delete_dir(self.at(name))
