"""Small files of a store that Spark reaches: created once, read, listed, deleted with their folder."""

from __future__ import annotations

from threading import Lock
from uuid import uuid4

from pyspark.sql import SparkSession

# A local file system renames over an existing file, so one process takes turns.
_RENAMING = Lock()


class Store:
    """The file system below one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm = spark._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(folder).getFileSystem(conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        """Names of the files and folders in ``folder``, none where it does not exist."""
        path = self._path(folder)
        if not self._fs.exists(path):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(path))

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Write a new file, whole or not at all; False when there is one of that name.

        The store's rename must not replace a file, as in HDFS.
        """
        draft = self._path(f"{path}.{uuid4().hex}.draft")
        stream = self._fs.create(draft, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        with _RENAMING:
            target = self._path(path)
            if not self._fs.exists(target) and self._fs.rename(draft, target):
                return True
        self._fs.delete(draft, False)
        return False

    def delete(self, path: str) -> None:
        """Delete a file, or a folder with all it holds."""
        self._fs.delete(self._path(path), True)
