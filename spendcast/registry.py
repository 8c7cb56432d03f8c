"""Small facts about jobs in numbered snapshots, with any number of writers.

A snapshot is one file that holds all rows. A commit reads the newest one, changes
its rows and writes the next number; a number that another writer took in the
meantime is a conflict, and the commit starts again from what that writer left. A
reader meets whole snapshots only, and older ones are removed, so the number of
files does not grow. Rows are few (the caller bounds them); they are read and
written by the driver without a Spark job.

A number is taken by a rename that fails where the name exists. That is one step on
HDFS; on a local disk the writers of one process are kept apart by a lock.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Callable
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

Rows = list[dict]
_LOCK = threading.Lock()
_KEPT_SNAPSHOTS = 3


def _java(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _is(error: Py4JJavaError, name: str) -> bool:
    return error.java_exception.getClass().getSimpleName() == name


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; an older one of that name is replaced."""
    target, files = _java(spark, path)
    out = files.create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file, or None if there is none."""
    target, files = _java(spark, path)
    try:
        stream = files.open(target)
    except Py4JJavaError as error:
        if not _is(error, "FileNotFoundException"):
            raise
        return None
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """The names of what a folder holds; none if it does not exist."""
    target, files = _java(spark, folder)
    try:
        return [status.getPath().getName() for status in files.listStatus(target)]
    except Py4JJavaError as error:
        if not _is(error, "FileNotFoundException"):
            raise
        return []


def move_if_absent(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file; False if the new name exists."""
    jvm = spark._jvm
    to, _ = _java(spark, target)
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(to.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(jvm.org.apache.hadoop.fs.Path(source), to, options)
    except Py4JJavaError as error:
        if not _is(error, "FileAlreadyExistsException"):
            raise
        return False
    return True


class SnapshotLog:
    """Rows below a folder; each row is a dictionary of plain values."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n in names_in(self.spark, self.folder) if n.endswith(".json") and n[:-5].isdigit())

    def _path(self, number: int) -> str:
        return f"{self.folder}/{number:012d}.json"

    def _newest(self) -> tuple[int, Rows]:
        while numbers := self._numbers():
            text = read_text(self.spark, self._path(numbers[-1]))
            if text is not None:  # else it was removed by a later commit: look again
                return numbers[-1], json.loads(text)
        return 0, []

    def rows(self) -> Rows:
        """The rows of the newest snapshot; none before the first commit."""
        return self._newest()[1]

    def commit(self, change: Callable[[Rows], Rows]) -> Rows:
        """Replace the rows by what ``change`` makes of them; it is called again after a conflict."""
        while True:
            number, before = self._newest()
            after = change([dict(r) for r in before])
            if after == before:
                return before
            passing = f"{self.folder}/.new-{uuid4().hex}"
            write_text(self.spark, passing, json.dumps(after))
            with _LOCK:
                won = move_if_absent(self.spark, passing, self._path(number + 1))
            if won:
                for old in self._numbers()[:-_KEPT_SNAPSHOTS]:
                    self._remove(self._path(old))
                return after
            self._remove(passing)

    def append(self, row: dict, keep: int) -> Rows:
        """One row more; of more than ``keep`` rows the oldest go."""
        return self.commit(lambda rows: [*rows, row][-keep:])

    def _remove(self, path: str) -> None:
        target, files = _java(self.spark, path)
        files.delete(target, False)
