"""File-system steps of publishing results, through Hadoop's FileSystem, so that any Spark path works."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.errors import UnsupportedOperationException
from pyspark.sql import SparkSession

_COPY_BUFFER = 4 << 20


class Files:
    """The file system of one path and its neighbours."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self.path(path).getFileSystem(self._conf)

    def path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self.path(path))

    def write(self, path: str, data: bytes) -> None:
        out = self._fs.create(self.path(path), True)
        try:
            out.write(data)
        finally:
            out.close()

    def delete(self, path: str) -> None:
        self._fs.delete(self.path(path), True)

    def replace(self, old: str, new: str) -> None:
        """``old`` under the name ``new``, in place of what has that name."""
        self.delete(new)
        self._fs.mkdirs(self.path(new).getParent())
        if not self._fs.rename(self.path(old), self.path(new)):
            raise OSError(f"could not rename {old} to {new}")

    def parts(self, folder: str) -> list[str]:
        """The part files of a Spark output folder that hold anything, in the order of their partitions."""
        found = []
        for status in self._fs.listStatus(self.path(folder)):
            name = status.getPath().getName()
            number = re.match(r"part-(\d+)", name)
            if number and status.getLen():
                found.append((int(number.group(1)), name, status.getPath().toString()))
        return [p for _, _, p in sorted(found)]

    def join(self, target: str, parts: Iterable[str]) -> None:
        """``parts`` appended to the file ``target``. Where the file system can concatenate (HDFS), only block lists
        change hands; elsewhere the bytes are copied through a buffer of 4 MB."""
        parts = list(parts)
        if not parts:
            return
        paths = self._jvm.java.lang.reflect.Array.newInstance(self.path(target).getClass(), len(parts))
        for i, part in enumerate(parts):
            paths[i] = self.path(part)
        try:
            self._fs.concat(self.path(target), paths)
            return
        except UnsupportedOperationException:
            pass
        whole = target + ".joining"
        out = self._fs.create(self.path(whole), True)
        try:
            for part in [target, *parts]:
                source = self._fs.open(self.path(part))
                try:
                    self._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, _COPY_BUFFER, False)
                finally:
                    source.close()
        finally:
            out.close()
        self.replace(whole, target)
