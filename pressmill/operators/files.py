"""Small metadata files on whatever file system the tables live on."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Files:
    """The few Hadoop file system calls a table folder needs."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        path = self._path(folder)
        if not self._fs.exists(path):
            return []
        names = (s.getPath().getName() for s in self._fs.listStatus(path))
        return sorted(n for n in names if not n.startswith((".", "_")))

    def create(self, path: str, content: dict) -> None:
        """Write a JSON file that must not exist yet.

        It is written under a hidden name and renamed when whole, so a crash
        leaves nothing that readers see. Object stores without atomic renames
        need a single writer.
        """
        folder, _, name = path.rpartition("/")
        hidden = self._path(f"{folder}/.{name}.{uuid.uuid4().hex}")
        stream = self._fs.create(hidden, False)
        try:
            stream.write(bytearray(json.dumps(content).encode()))
        finally:
            stream.close()
        if self._fs.exists(self._path(path)) or not self._fs.rename(hidden, self._path(path)):
            self._fs.delete(hidden, False)
            raise FileExistsError(f"{path} already exists")

    def load(self, path: str) -> dict:
        stream = self._fs.open(self._path(path))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
