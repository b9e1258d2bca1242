"""Folders and small files of any file system that Spark reaches."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession

COMPLETE = "_SUCCESS"


class Files:
    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._fs = self._path(root).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def is_folder(self, path: str) -> bool:
        return self.exists(path) and self._fs.getFileStatus(self._path(path)).isDirectory()

    def folders(self, path: str) -> list[str]:
        """Names of the folders right below; none if there is no such folder."""
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path)) if s.isDirectory())

    def make(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def read(self, path: str) -> str:
        """A small file's text; empty if there is none."""
        if not self.exists(path):
            return ""
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """Put a small file in place whole: a reader sees the old text or the new one, never a part or nothing."""
        new = self._path(f"{path}.{uuid.uuid4().hex[:12]}")
        stream = self._fs.create(new, True)
        stream.write(text.encode())
        stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        array = self._jvm.java.lang.reflect.Array.newInstance(rename.OVERWRITE.getClass(), 1)
        self._jvm.java.lang.reflect.Array.set(array, 0, rename.OVERWRITE)
        context.rename(new, self._path(path), array)


def numbered(names: Sequence[str], prefix: str) -> list[tuple[int, str]]:
    """(number, name) of names like ``<prefix>000012-abc``, by number."""
    found = []
    for name in names:
        number = name.removeprefix(prefix).partition("-")[0]
        if name.startswith(prefix) and number.isdigit():
            found.append((int(number), name))
    return sorted(found)
