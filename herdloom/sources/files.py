"""Folders on whatever file system Spark reads: names, marks and moves, never contents."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    """A folder seen through the client that Spark itself uses. It need not exist."""

    def __init__(self, spark: SparkSession, path: str):
        self.path, self._spark = path.rstrip("/"), spark
        self._new_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._own = self._new_path(self.path)
        self._files = self._own.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._new_path(self._own, name)

    def sub(self, name: str) -> Folder:
        return Folder(self._spark, f"{self.path}/{name}")

    def exists(self) -> bool:
        return self._files.exists(self._own)

    def names(self) -> list[str]:
        """Names of what it holds, in order; none without the folder."""
        if not self.exists():
            return []
        return sorted(status.getPath().getName() for status in self._files.listStatus(self._own))

    def data(self) -> list[str]:
        """Names of data files and folders: those that Spark reads."""
        return [name for name in self.names() if name[0] not in "._"]

    def make(self) -> Folder:
        self._files.mkdirs(self._own)
        return self

    def mark(self, name: str) -> None:
        """Create an empty file, which is there as a whole or not at all."""
        self._files.create(self._at(name), True).close()

    def delete(self, name: str | None = None) -> None:
        """Delete an entry, or the folder, with all below it; nothing if it is not there."""
        self._files.delete(self._own if name is None else self._at(name), True)

    def move(self, name: str, target: Folder) -> None:
        """Move an entry into another folder of the same file system, under its name."""
        target.make()
        if not self._files.rename(self._at(name), target._at(name)):
            raise OSError(f"{self.path}/{name} can't be moved to {target.path}")
