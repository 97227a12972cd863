"""Numbered versions of a small state in a shared folder, made by whoever comes first.

    <folder>/00000000000000000042.json

A version is never changed. The next one is made by create-if-absent, so of two writers
that start from one version one succeeds; the other reads what it has missed, checks
whether its change still holds, and tries again. That gives all changes one order.

The file systems do the deciding: a rename that refuses to replace (HDFS and others behind
Hadoop's FileContext), or a hard link on a local disk. Stores in which neither is atomic
cannot have several writers.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

TRIES = 200


class Conflict(RuntimeError):
    """What a change was made from is no longer there."""


class Folder:
    """The few file calls that versions need, on any file system the session knows."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._path = self._jvm.org.apache.hadoop.fs.Path(path)
        self._files = self._path.getFileSystem(self._conf)
        self._local = self._files.getUri().getScheme() == "file"

    def names(self) -> list[str]:
        if not self._files.exists(self._path):
            return []
        return [s.getPath().getName() for s in self._files.listStatus(self._path)]

    def read(self, name: str) -> str:
        stream = self._files.open(self._child(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Whether the file was made; False when there is one of that name. It is seen whole or not at all."""
        temporary = self._child(f"_{uuid.uuid4().hex}")
        self._files.mkdirs(self._path)
        out = self._files.create(temporary)
        out.write(text.encode("utf-8"))
        out.close()
        try:
            if self._local:
                nio = lambda p: self._jvm.java.io.File(self._files.makeQualified(p).toUri().getPath()).toPath()
                self._jvm.java.nio.file.Files.createLink(nio(self._child(name)), nio(temporary))
            else:
                rename = self._jvm.org.apache.hadoop.fs.Options.Rename
                context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path.toUri(), self._conf)
                context.rename(temporary, self._child(name), self._array(rename.NONE))
            return True
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                return False
            raise
        finally:
            self._files.delete(temporary, False)

    def _array(self, option):
        from pyspark import SparkContext

        array = SparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)  # type: ignore[union-attr]
        array[0] = option
        return array

    def _child(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._path, name)


class CommitLog:
    """The versions of one state, a JSON document. `folder` has names(), read(name) and create(name, text)."""

    def __init__(self, folder):
        self.folder = folder

    def latest(self) -> tuple[int, dict | None]:
        """The newest version and its state, (-1, None) before the first."""
        numbers = [int(n[:-5]) for n in self.folder.names() if n.endswith(".json") and n[:-5].isdigit()]
        if not numbers:
            return -1, None
        newest = max(numbers)
        return newest, json.loads(self.folder.read(f"{newest:020d}.json"))

    def commit(self, change: Callable[[dict | None], dict]) -> dict:
        """The state after the change. `change` makes the new state of the newest one, and is asked again when
        another writer was faster; it raises Conflict when it no longer holds."""
        for _ in range(TRIES):
            version, state = self.latest()
            changed = change(state)
            if changed is state or self.folder.create(f"{version + 1:020d}.json", json.dumps(changed)):
                return changed
        raise Conflict(f"no turn in {TRIES} tries")
