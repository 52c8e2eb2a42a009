"""Replacing parts of a partitioned table as one step.

New partitions are written beside the old ones, in a folder that readers do not see. Then a list of what is to be replaced
and removed is put in place by one rename: from there on the change holds. The folders named are swapped by renames, the old ones first moved
aside, and what is left over is removed. A run that dies before the list leaves the old table; one that dies after
it leaves a list, and whoever opens the table next (``recover``) completes the swap. Every step can be done twice.

This needs a file system whose renames are atomic, such as HDFS. One job at a time may write a table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Names that begin with an underscore are no part of a table to Spark.
_NEW, _OLD, _LIST = "_new", "_old", "_swap"


class Folder:
    """A folder of any file system that Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.root = path.rstrip("/")
        self.system = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, *names: str):
        return self._path("/".join([self.root, *names]))

    def exists(self, *names: str) -> bool:
        return self.system.exists(self.at(*names))

    def folders(self, *names: str) -> list[str]:
        if not self.exists(*names):
            return []
        return sorted(s.getPath().getName() for s in self.system.listStatus(self.at(*names)) if s.isDirectory())

    def move(self, source: str, target: str) -> None:
        """Renames ``source`` unless that was done before."""
        if not self.exists(source):
            return
        self.system.mkdirs(self.at(target).getParent())
        if not self.system.rename(self.at(source), self.at(target)) and self.exists(source):
            raise OSError(f"cannot rename {self.at(source)} to {self.at(target)}")

    def remove(self, *names: str) -> None:
        self.system.delete(self.at(*names), True)

    def partitions(self, keys: list[str], *below: str) -> dict[str, dict[str, str]]:
        """Relative paths of the partitions, with their values as they stand in the folders' names."""
        level = {"": {}}
        for k in keys:
            level = {
                f"{parent}/{name}".lstrip("/"): {**values, k: name[len(k) + 1 :]}
                for parent, values in level.items()
                for name in self.folders(*below, *([parent] if parent else []))
                if name.startswith(f"{k}=")
            }
        return level

    def write(self, name: str, text: str) -> None:
        """The file appears whole: it is renamed from another name."""
        stream = self.system.create(self.at(f"{name}.part"), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        self.move(f"{name}.part", name)

    def read(self, name: str) -> str:
        size = self.system.getFileStatus(self.at(name)).getLen()
        stream = self.system.open(self.at(name))
        data = bytes(stream.readNBytes(size))
        stream.close()
        return data.decode()


def recover(spark: SparkSession, path: str) -> None:
    """Completes a swap that was decided; a table without one is left as it is."""
    folder = Folder(spark, path)
    if folder.exists(_LIST):
        _complete(folder, json.loads(folder.read(_LIST)))


def _complete(folder: Folder, listed: dict) -> None:
    for part in listed["replaced"]:
        if folder.exists(_NEW, part):
            folder.move(part, f"{_OLD}/{part}")
            folder.move(f"{_NEW}/{part}", part)
    for part in listed["removed"]:
        folder.move(part, f"{_OLD}/{part}")
    for name in (_NEW, _OLD, _LIST):
        folder.remove(name)


def swapped(
    df: DataFrame,
    write: Callable[[DataFrame, str], None],
    path: str,
    handled: Callable[[dict[str, str]], bool],
    keys: list[str],
) -> list[str]:
    """Writes ``df``, replaces the partitions it holds and removes handled ones that it does not.

    Returns the relative paths of the partitions written.
    """
    spark = df.sparkSession
    recover(spark, path)
    folder = Folder(spark, path)
    for name in (_NEW, _OLD, f"{_LIST}.part"):  # left by a run that decided nothing
        folder.remove(name)
    write(df, f"{folder.root}/{_NEW}")
    written = sorted(folder.partitions(keys, _NEW))
    gone = [part for part, values in folder.partitions(keys).items() if handled(values) and part not in written]
    listed = {"id": uuid.uuid4().hex, "replaced": written, "removed": sorted(gone)}
    folder.write(_LIST, json.dumps(listed))
    _complete(folder, listed)
    return written
