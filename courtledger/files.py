"""Small files and folders on whatever file system the tables lie."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """The file system of a path. For records of a few kilobytes; data goes through Spark."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._system = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        """Sorted names in a folder; none where it does not exist."""
        place = self._path(folder)
        if not self._system.exists(place):
            return []
        return sorted(entry.getPath().getName() for entry in self._system.listStatus(place))

    def modified(self, path: str) -> int:
        return self._system.getFileStatus(self._path(path)).getModificationTime()

    def size(self, path: str) -> int:
        return self._system.getContentSummary(self._path(path)).getLength()

    def read(self, path: str) -> str:
        stream = self._system.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        stream = self._system.create(self._path(path), True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()

    def rename(self, source: str, target: str) -> bool:
        """Moves a file to a name that must be free."""
        place = self._path(target)
        return not self._system.exists(place) and self._system.rename(self._path(source), place)

    def delete(self, path: str) -> None:
        self._system.delete(self._path(path), True)
