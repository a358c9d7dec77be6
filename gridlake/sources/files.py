"""Folders of a table, through Hadoop's file system: what Spark reads, this lists (local paths, HDFS, object stores)."""
from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    """A folder and the file system that holds it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, *names: str) -> str:
        return "/".join([self.path, *names]) if self.path else "/"

    def exists(self, *names: str) -> bool:
        return self._fs.exists(self._path(self.at(*names)))

    def is_folder(self) -> bool:
        return self.exists() and self._fs.getFileStatus(self._path(self.path)).isDirectory()

    def folders(self, *names: str) -> list[str]:
        """Names of the folders below, sorted; none where there is no such folder."""
        if not self.exists(*names):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(self.at(*names))) if s.isDirectory())

    def data_files(self, suffix: str, *names: str) -> list[str]:
        """Full paths of the files below (not in folders), sorted, without hidden ones."""
        found = [s.getPath() for s in self._fs.listStatus(self._path(self.at(*names))) if s.isFile()]
        return sorted(p.toString() for p in found if p.getName().endswith(suffix) and p.getName()[0] not in "._")

    def first_line(self, path: str) -> str:
        """The first line of a text file (the stream is closed after it)."""
        codecs = self.spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(self.spark._jsc.hadoopConfiguration())
        place = self._path(path)
        stream, codec = self._fs.open(place), codecs.getCodec(place)
        io = self.spark._jvm.java.io
        reader = io.BufferedReader(io.InputStreamReader(stream if codec is None else codec.createInputStream(stream), "UTF-8"))
        try:
            return (reader.readLine() or "").lstrip("﻿")
        finally:
            reader.close()

    def delete(self, *names: str) -> bool:
        return self._fs.delete(self._path(self.at(*names)), True)


def committed(folder: Folder, *names: str) -> bool:
    """Whether Spark's committer has finished this folder."""
    return folder.exists(*names, "_SUCCESS")
