"""Files and folders through Hadoop's file systems, the folder that tasks share, and results that are written once."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


class Files:
    """What lies below a path, wherever its scheme points to."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._new = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._new(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def is_file(self, path: str) -> bool:
        at = self._new(path)
        return self._fs.exists(at) and self._fs.getFileStatus(at).isFile()

    def is_folder(self, path: str) -> bool:
        at = self._new(path)
        return self._fs.exists(at) and self._fs.getFileStatus(at).isDirectory()

    def below(self, path: str, suffix: str) -> Iterator[str]:
        """Files with a suffix, at any depth, listed as they are asked for."""
        found = self._fs.listFiles(self._new(path), True)
        while found.hasNext():
            name = found.next().getPath().toString()
            if name.endswith(suffix):
                yield name

    def folders(self, path: str) -> list[str]:
        """The names of the folders right below a path."""
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._new(path)) if s.isDirectory()) if self.is_folder(path) else []

    def move(self, path: str, to: str) -> None:
        target = self._new(to)
        self._fs.mkdirs(target.getParent())
        if not self._fs.rename(self._new(path), target):
            raise OSError(f"can't move {path} to {to}")

    def delete(self, path: str) -> None:
        self._fs.delete(self._new(path), True)


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate data that all tasks reach: the session's spark.checkpoint.dir.

    Where none is named, a session on this machine alone gets a temporary one; on a cluster that is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not named and context._jsc.sc().getCheckpointDir().isDefined():
        named = context._jsc.sc().getCheckpointDir().get()
    if not named:
        if not context.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir names no folder that the executors share")
        import atexit
        import shutil
        import tempfile

        named = tempfile.mkdtemp(prefix="lexloom-")
        atexit.register(shutil.rmtree, named, True)
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(named)
    return named.rstrip("/")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and written to the shared folder, so that what follows survives lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
