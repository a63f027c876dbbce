"""Files in shared storage, reached through the Hadoop file system API."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


class Storage:
    """The file system that holds ``path``. All calls are small driver-side requests."""

    def __init__(self, spark: SparkSession, path: str):
        context = spark.sparkContext
        self._hadoop = context._jvm.org.apache.hadoop
        self._java = context._jvm.java.io
        self._fs = self._path(path).getFileSystem(context._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """Names in a folder; empty when there is no such folder."""
        if not self.exists(path):
            return []
        return [status.getPath().getName() for status in self._fs.listStatus(self._path(path))]

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(self._hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
        finally:
            stream.close()

    def first_line(self, path: str) -> str:
        """The first line of a text file, compressed or not; empty for an empty file."""
        codecs = self._hadoop.io.compress.CompressionCodecFactory(self._fs.getConf())
        codec = codecs.getCodec(self._path(path))
        stream = self._fs.open(self._path(path))
        try:
            java = self._java
            source = stream if codec is None else codec.createInputStream(stream)
            return java.BufferedReader(java.InputStreamReader(source, "UTF-8")).readLine() or ""
        finally:
            stream.close()

    def write_new(self, path: str, text: str) -> None:
        """Create a small file in one step; refuses to replace one."""
        draft = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
        stream = self._fs.create(self._path(draft), False)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        try:
            self.rename(draft, path)
        except FileExistsError:
            self.delete(draft)
            raise

    def rename(self, source: str, target: str) -> None:
        """Move a file or folder in one step; refuses to replace anything."""
        self.make_folder(target.rpartition("/")[0])
        if self.exists(target) or not self._fs.rename(self._path(source), self._path(target)):
            raise FileExistsError(f"{target} exists; is there a second writer?")

    def make_folder(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def delete_on_exit(self, path: str) -> None:
        self._fs.deleteOnExit(self._path(path))


@cache
def _local_folder() -> str:
    """One temporary folder for the sessions of this process."""
    return tempfile.mkdtemp(prefix="cabtally-")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach, as ``spark.checkpoint.dir`` names it.

    Only a local session that names none gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    folder = spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    return _local_folder()


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared one, deleted when the driver ends."""
    path = f"{shared_folder(spark).rstrip('/')}/cabtally/{purpose}-{uuid.uuid4().hex}"
    storage = Storage(spark, path)
    storage.make_folder(path)
    storage.delete_on_exit(path)
    return path
