"""Moves and notes on the file system of a table, whichever Spark reaches it by."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

MOVERS = 16  # renames under way at a time


class FileStore:
    """A Hadoop file system, through the session's JVM. Paths are qualified."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str) -> tuple:
        location = self._jvm.org.apache.hadoop.fs.Path(path)
        return location.getFileSystem(self._conf), location

    def exists(self, path: str) -> bool:
        files, location = self._at(path)
        return files.exists(location)

    def names(self, path: str) -> list[tuple[str, bool]]:
        """(name, is a folder) of what a folder holds; none if there is no such folder."""
        files, location = self._at(path)
        if not files.exists(location):
            return []
        return sorted((s.getPath().getName(), s.isDirectory()) for s in files.listStatus(location))

    def move(self, source: str, target: str) -> None:
        """Give a file or folder another name; the folder above it is made if needed."""
        files, location = self._at(source)
        to = self._jvm.org.apache.hadoop.fs.Path(target)
        files.mkdirs(to.getParent())
        if not files.rename(location, to):
            raise OSError(f"cannot move {source} to {target}")

    def remove(self, path: str) -> None:
        files, location = self._at(path)
        files.delete(location, True)

    def read_json(self, path: str) -> dict | None:
        """What ``write_json`` left there, None if it did not get to its end."""
        files, location = self._at(path)
        if not files.exists(location):
            return None
        try:
            stream = files.open(location)
        except Py4JJavaError:
            if files.exists(location):
                raise
            return None  # its run has just ended
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def write_json(self, path: str, value: dict) -> None:
        """Write a note that is there as a whole or not at all."""
        files, location = self._at(f"{path}.new")
        stream = files.create(location, True)
        stream.write(json.dumps(value).encode())
        stream.close()
        to = self._jvm.org.apache.hadoop.fs.Path(path)
        if files.exists(to):
            files.delete(to, False)
        if not files.rename(location, to):
            raise OSError(f"cannot write {path}")

    def move_all(self, moves: Iterable[tuple[str, str]]) -> None:
        """Several moves, many at a time."""
        with ThreadPoolExecutor(MOVERS) as pool:
            for _ in pool.map(lambda pair: self.move(*pair), list(moves)):
                pass

    def files_below(self, path: str, inside: str = "") -> Iterator[str]:
        """Relative names of the data files below a folder."""
        for name, is_folder in self.names(f"{path}/{inside}" if inside else path):
            if name.startswith(("_", ".")):
                continue
            relative = f"{inside}/{name}" if inside else name
            if is_folder:
                yield from self.files_below(path, relative)
            else:
                yield relative
