"""A log of commits in which each number can be taken once.

A commit is a small file whose name is its number. It is written under
another name first and then given its own, which fails if there is one: of writers that
try the same number one wins, and no reader sees half a commit.
"""

from __future__ import annotations

import json
import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark import SparkContext
from pyspark.sql import SparkSession


class CommitConflict(RuntimeError):
    """Another writer took the number first."""


class CommitLog:
    """Commits ``0.json, 1.json, ...`` in a folder of any file system that Spark reaches.

    On a local disk a hard link gives a file its name, elsewhere a rename that does not overwrite: both are one
    step of the file system. (An object store without such a rename needs a committer of its own.)
    """

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")
        self._root = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._files = self._root.getFileSystem(self._conf)

    def _file(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._root, name)

    def numbers(self) -> list[int]:
        """The numbers of all commits, rising."""
        if not self._files.exists(self._root):
            return []
        names = (status.getPath().getName() for status in self._files.listStatus(self._root))
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def read(self, number: int) -> dict:
        stream = self._files.open(self._file(f"{number}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")) | {"version": number}
        finally:
            stream.close()

    def last(self) -> dict | None:
        numbers = self.numbers()
        return self.read(numbers[-1]) if numbers else None

    def add(self, number: int, content: dict) -> None:
        """Commit ``content`` under ``number``; ``CommitConflict`` if the number is taken."""
        draft = self._file(f"_draft-{uuid.uuid4().hex}")
        stream = self._files.create(draft, False)
        stream.write(json.dumps(content).encode())
        stream.close()
        try:
            self._name(draft, self._file(f"{number}.json"))
        finally:
            self._files.delete(draft, False)

    def _name(self, draft, target) -> None:
        whole = self._files.makeQualified(target).toUri()
        if whole.getScheme() == "file":
            try:
                os.link(self._files.makeQualified(draft).toUri().getPath(), whole.getPath())
            except FileExistsError as taken:
                raise CommitConflict(f"taken: {target}") from taken
            return
        kinds = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        no_overwrite = SparkContext._gateway.new_array(kinds, 1)
        no_overwrite[0] = kinds.NONE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(whole, self._conf)
        try:
            context.rename(draft, target, no_overwrite)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" not in str(error.java_exception):
                raise
            raise CommitConflict(f"taken: {target}") from error
