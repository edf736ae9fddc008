"""Replacing a stored folder without a moment at which its rows are lost.

New rows are written to a hidden folder beside the old one, and take its place by
renames once their job has committed.  A failed job leaves the old folder as it was; a
driver lost between the two renames leaves the old folder under its hidden name, and the
next replacement or look at the folder puts it back.  Renames are one step on HDFS and
shared file systems; on an object store they copy, but still only after the commit.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

_NEXT, _LAST = "_next-", "_last-"


class Folder:
    """A folder on any Hadoop file system, by its path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    @property
    def parent(self) -> str:
        return self.path.rpartition("/")[0]

    @property
    def name(self) -> str:
        return self.path.rpartition("/")[2]

    def has(self, path: str | None = None) -> bool:
        return self._fs.exists(self._path(path or self.path))

    def children(self) -> list[str]:
        """Names in the folder; empty if there is none."""
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(self.path))) if self.has() else []

    def files(self) -> list[tuple[str, int, int]]:
        """Name, size and time of change of each file in the folder itself."""
        entries = self._fs.listStatus(self._path(self.path)) if self.has() else []
        return sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in entries if s.isFile())

    def delete(self, path: str | None = None) -> None:
        self._fs.delete(self._path(path or self.path), True)

    def move(self, source: str, target: str) -> None:
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot rename {source} to {target}")

    def beside(self) -> str:
        """A new hidden folder beside this one, which scans of the table skip."""
        return f"{self.parent}/{_NEXT}{self.name}-{uuid.uuid4().hex[:12]}"

    def recover(self) -> None:
        """Puts the old folder back if a replacement stopped between its renames."""
        last = f"{self.parent}/{_LAST}{self.name}"
        if not self.has(last):
            return
        if self.has():
            self.delete(last)
        else:
            self.move(last, self.path)

    def replace_by(self, written: str) -> None:
        """The folder ``written`` takes this one's place."""
        self.recover()
        last = f"{self.parent}/{_LAST}{self.name}"
        if self.has():
            self.move(self.path, last)
        else:
            self._fs.mkdirs(self._path(self.parent))
        self.move(written, self.path)
        if self.has(last):
            self.delete(last)

    def add_files(self, written: str) -> None:
        """Moves the files of a committed write into this folder, its marker last."""
        self._fs.mkdirs(self._path(self.path))
        for name, _, _ in Folder(self.spark, written).files():
            if not name.startswith(("_", ".")):
                self.move(f"{written}/{name}", f"{self.path}/{name}")
        marker = f"{self.path}/_SUCCESS"
        if not self.has(marker):
            self._fs.create(self._path(marker), True).close()

    def remove(self) -> None:
        """Removes the folder and what an earlier replacement may have left of it."""
        self.recover()
        if self.has():
            self.delete()


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file, unless one is there; True if this call made it.

    The file appears with its whole text, and of several calls at once one makes it:
    it is written aside and renamed, which HDFS refuses onto a file that is there.  Where
    a rename replaces the file (local folders), it is linked instead.  On an object store,
    whose rename copies, two calls in the same moment may both see their own file.
    """
    folder = Folder(spark, path.rpartition("/")[0])
    name = path.rpartition("/")[2]
    target = folder._path(path)
    aside = f"{folder.path}/{_NEXT}{name}-{uuid.uuid4().hex[:12]}"
    folder._fs.mkdirs(folder._path(folder.path))
    stream = folder._fs.create(folder._path(aside), False)
    try:
        stream.write(bytearray(text.encode()))
        stream.close()
        if folder.has(path):
            return False
        if folder._fs.getScheme() == "file":
            try:
                os.link(folder._path(aside).toUri().getPath(), target.toUri().getPath())
            except FileExistsError:
                return False
            return True
        return folder._fs.rename(folder._path(aside), target)
    finally:
        if folder.has(aside):
            folder.delete(aside)


def read_file(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    folder = Folder(spark, path)
    stream = folder._fs.open(folder._path(path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
