"""Tables that are replaced as a whole, version by version.

Parquet has no MERGE, DELETE or identity column, so a change writes the whole
(small) table to a new folder and then commits that folder under the next number. Readers see the
last committed version; a run that dies in between leaves the old one valid.
Of several writers one wins a number; the others read what it wrote, make their change
anew on top of it and take a later number, so no change is lost.
"""

from __future__ import annotations

import random
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from colmask import schemas
from colmask.functions.names import quote_ident
from colmask.operators.control import (
    assign_ids,
    duplicate_keys,
    flagged,
    merge_control,
    prune_control,
)
from colmask.operators.tokens import known_tokens, new_tokens
from colmask.session import ROWS_PER_FILE, drop_folder, stored, work_area
from colmask.sources.commits import CommitConflict, CommitLog

#: Folders of one level of a growing table that a change merges into one of the next level.
MOST_FOLDERS = 16


class VersionedTable:
    """A commit names the folders that hold the version's rows, and the highest number given out so far."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.log = CommitLog(spark, f"{self.path}/commits")

    def _commit(self, version: int | None = None) -> dict | None:
        if version is None:
            return self.log.last()
        return self.log.read(version) if version in self.log.numbers() else None

    def version(self) -> int | None:
        """Number of the committed version, None before the first one."""
        numbers = self.log.numbers()
        return numbers[-1] if numbers else None

    def create(self) -> None:
        """Make an empty table unless there is one."""
        if self.version() is None:
            try:
                self._write(self.spark.createDataFrame([], self.schema), None)
            except CommitConflict:
                pass

    def read(self, version: int | None = None) -> DataFrame:
        return self._rows(self._commit(version))

    def _rows(self, commit: dict | None) -> DataFrame:
        return self._folders([] if commit is None else commit["folders"])

    def _folders(self, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/rows/{f}" for f in folders])

    def write(self, df: DataFrame) -> int:
        """Replace all rows; ``CommitConflict`` if another writer commits meanwhile, whose rows ``df`` cannot know."""
        return self._write(df, self._commit())

    def update(self, change: Callable[[DataFrame, int], DataFrame]) -> int:
        """Replace the rows by ``change(rows, highest number)``, made anew on top of what other writers commit meanwhile."""
        while True:
            last = self._commit()
            try:
                return self._write(change(self._rows(last), 0 if last is None else last["high"]), last)
            except CommitConflict:
                time.sleep(random.uniform(0, 0.2))

    def _write(self, df: DataFrame, last: dict | None, kept: Sequence[str] = (), **content) -> int:
        version = 0 if last is None else last["version"] + 1
        folder = f"{version}-{uuid.uuid4().hex}"
        names = StructType.fromDDL(self.schema).names
        rows = df.select(*map(quote_ident, names))
        rows.write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(f"{self.path}/rows/{folder}")
        high = max(self._highest(folder), 0 if last is None else last["high"])
        try:
            self.log.add(version, {"folders": [*kept, folder], "high": high, **content})
        except CommitConflict:
            drop_folder(self.spark, f"{self.path}/rows/{folder}")
            raise
        return version

    def _highest(self, folder: str) -> int:
        return 0


class ControlTable(VersionedTable):
    """The control table in a folder."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__(spark, path, schemas.CONTROL)

    def flagged(self) -> DataFrame:
        return flagged(self.read())

    def add(self, matches: DataFrame, keep_flag: bool = True) -> int:
        """Merge discovered columns in; refuses a column listed twice."""
        with work_area(self.spark):
            matches = stored(matches, "matches")
            version = self.version()
            if version is not None and matches.isEmpty():
                return version
            twice = duplicate_keys(matches).first()
            if twice is not None:
                raise ValueError(f"listed twice: {twice['TableName']}.{twice['ColumnName']}")
            return self.update(lambda rows, high: merge_control(rows, matches, keep_flag, high))

    def _highest(self, folder: str) -> int:
        """The largest Id: kept with the commit, so that the Ids of pruned rows are not given out again."""
        rows = self.spark.read.schema(self.schema).parquet(f"{self.path}/rows/{folder}")
        return rows.agg(F.coalesce(F.max("Id"), F.lit(0))).first()[0]

    def prune(self, dead_tables: DataFrame) -> int:
        return self.update(lambda rows, _: prune_control(rows, dead_tables))

    def replace(self, rows: DataFrame) -> int:
        """Start over with ``rows``, numbered on from the highest Id there was."""
        with work_area(self.spark):
            return self.update(lambda _, high: assign_ids(rows.drop("Id"), after=high))


def merge_from(levels: Sequence[int], most: int) -> tuple[int, int]:
    """Where the folders start that a new one is merged with, and the level of what comes of them.

    ``levels`` never rise along the folders. As soon as ``most`` folders of a level would stand at the end they become one
    of the next level, which may in turn be the last that one needs.
    """
    start, level = len(levels), 0
    while True:
        first = start
        while first and levels[first - 1] == level:
            first -= 1
        if start - first + 1 < most:
            return start, level
        start, level = first, level + 1


class GrowingTable(VersionedTable):
    """A table whose versions add rows to the ones before.

    A change writes a folder with its rows alone, and now and then merges the last ``MOST_FOLDERS`` of a level into
    it. So n versions are read from fewer than ``MOST_FOLDERS`` folders for each of some log(n) levels, and a row is
    written again once a level.
    """

    def _append(self, added: DataFrame, last: dict | None, **content) -> int:
        folders = [] if last is None else last["folders"]
        levels = [0] * len(folders) if last is None else last.get("levels", [0] * len(folders))
        start, level = merge_from(levels, MOST_FOLDERS)
        if start < len(folders):
            added = self._folders(folders[start:]).unionByName(added)
        return self._write(added, last, folders[:start], levels=[*levels[:start], level], **content)


class Vault(GrowingTable):
    """The token table in a folder. It holds stored values: keep it as safe as they are."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__(spark, path, schemas.VAULT)

    def add(self, df: DataFrame, columns: str | Sequence[str], few: bool = False) -> int:
        """Give every new value of the columns a token; the number of the version that has them all.

        With ``few`` the values are looked up first: the vault is then read, but not shuffled, if the values are few
        enough to be broadcast. Values that all have tokens make no new version.
        """
        while True:
            with work_area(self.spark):
                last = self._commit()
                rows = self._rows(last)
                known = stored(known_tokens(rows, df, columns), "known") if few else None
                added = new_tokens(rows, df, columns, known)
                if few:
                    added = stored(added, "tokens")
                    if last is not None and added.isEmpty():
                        return last["version"]
                try:
                    return self._append(added, last)
                except CommitConflict:
                    time.sleep(random.uniform(0, 0.2))

    def lookup(self, df: DataFrame, columns: str | Sequence[str], version: int | None = None) -> DataFrame:
        """The rows of the vault for the values of the columns."""
        return known_tokens(self.read(version), df, columns)


class StreamedCopy(GrowingTable):
    """Rows that streams add batch by batch, each batch once.

    A commit names the last batch of every stream, so a batch that comes again after a crash is known. Several streams
    may add to one copy.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str | None = None):
        super().__init__(spark, path, schema or "")
        last = self._commit()
        if schema is None and last is None:
            raise ValueError(f"nothing was copied to {self.path} yet")
        if schema is None:
            self.schema = last["schema"]
        elif last is not None and StructType.fromDDL(last["schema"]) != StructType.fromDDL(schema):
            raise ValueError(f"{self.path} has other columns: {last['schema']}")

    def has_batch(self, stream: str, batch: int) -> bool:
        return self._has(self._commit(), stream, batch)

    @staticmethod
    def _has(commit: dict | None, stream: str, batch: int) -> bool:
        return commit is not None and batch <= commit["batches"].get(stream, -1)

    def add_batch(self, rows: DataFrame, stream: str, batch: int) -> bool:
        """Add the rows of a batch; False if it was added before."""
        while True:
            last = self._commit()
            if self._has(last, stream, batch):
                return False
            batches = ({} if last is None else last["batches"]) | {stream: batch}
            try:
                self._append(rows, last, batches=batches, schema=self.schema)
                return True
            except CommitConflict:
                time.sleep(random.uniform(0, 0.2))
