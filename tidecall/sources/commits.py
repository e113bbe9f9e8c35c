"""A log of numbered entries per name that several jobs may write at once."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from tidecall.schema import LOAD_LOG

#: Entries per folder, so that no listing grows with the log.
PER_FOLDER = 1000


class CommitLog:
    """Entries as small files ``root/<name>/<folder>/<version>.json``.

    A version is taken by giving a complete file its name, which fails if another writer was
    first; that writer's version then counts and the next one is tried. Versions are therefore
    distinct and without gaps, and no reader sees half an entry. This needs a file system whose
    rename is atomic and does not replace, as HDFS and local disks have.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        path = self._path(self.root)
        self.fs = path.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, text: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(text)

    def _folder(self, name: str) -> str:
        return f"{self.root}/{quote(name, safe='')}"

    def _file(self, name: str, version: int) -> str:
        return f"{self._folder(name)}/{version // PER_FOLDER:012d}/{version:015d}.json"

    def _listed(self, folder: str) -> list[str]:
        path = self._path(folder)
        if not self.fs.exists(path):
            return []
        return sorted(n for s in self.fs.listStatus(path) if (n := s.getPath().getName())[0].isdigit())

    def newest(self, name: str) -> int:
        """The newest version, 0 if there is none: two listings of at most a thousand files or folders of them."""
        folders = self._listed(self._folder(name))
        for folder in reversed(folders):
            if files := self._listed(f"{self._folder(name)}/{folder}"):
                return int(files[-1].split(".")[0])
        return 0

    def append(self, name: str, operation: str, rows: int) -> int:
        """Write an entry and return the version that it got."""
        version = self.newest(name) + 1
        while not self._claim(name, version, operation, rows):
            version = max(version, self.newest(name)) + 1
        return version

    def _claim(self, name: str, version: int, operation: str, rows: int) -> bool:
        entry = {
            "table_name": name,
            "version": version,
            "timestamp": dt.datetime.now(dt.timezone.utc).isoformat(timespec="microseconds"),
            "operation": operation,
            "num_rows": rows,
        }
        target = self._file(name, version)
        draft = self._path(f"{self._folder(name)}/_{uuid.uuid4().hex}")
        self.fs.mkdirs(self._path(target).getParent())
        out = self.fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(entry).encode()))
        finally:
            out.close()
        try:
            return self._publish(draft, self._path(target))
        finally:
            self.fs.delete(draft, False)

    def _publish(self, draft, target) -> bool:
        """Give the draft the target's name unless it is taken."""
        if self.fs.getUri().getScheme() != "file":
            return self.fs.rename(draft, target)
        jvm = self.spark._jvm
        local = [jvm.java.io.File(self.fs.makeQualified(p).toUri().getPath()).toPath() for p in (target, draft)]
        try:
            jvm.java.nio.file.Files.createLink(*local)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        return True

    def read(self, name: str, limit: int) -> DataFrame:
        """The newest ``limit`` entries; only their files are read."""
        newest = self.newest(name)
        paths = [self._file(name, v) for v in range(max(1, newest - limit + 1), newest + 1)]
        if not paths:
            return self.spark.createDataFrame([], LOAD_LOG)
        return self.spark.read.schema(LOAD_LOG).json(paths)
