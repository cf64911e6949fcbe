"""Masked copies that follow their source file by file.

A copy keeps a manifest of the source's files. A run masks the files that
are new, drops the rows of those that are gone or were replaced, and commits both as one version: readers
see the old copy or the new one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colmask.functions.names import free_name, quote_ident, quote_table
from colmask.functions.redact import MASK_FUNCTIONS
from colmask.operators.planning import mask_plan
from colmask.plans.mask import RunLog, by_table, mask_table, raise_failures, sort_out
from colmask.session import drop_folder, stored, work_area
from colmask.sources.commits import CommitLog
from colmask.sources.versions import ControlTable

#: Files that one job masks: what the driver lists at once.
FILES_AT_ONCE = 10_000
MANIFEST = "path string, file bigint, folder string"


def file_id() -> Column:
    """A file as it is now: another size or time makes it another file."""
    return F.xxhash64("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")


def source_files(spark: SparkSession, root: str) -> DataFrame:
    """``path, file`` of every data file under ``root``; the files are listed, not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return listed.filter(F.col("length") > 0).select("path", file_id().alias("file"))


@dataclass(frozen=True)
class FollowRun:
    """What a run did: the committed version, and how many files were masked, dropped and kept."""

    version: int
    n_new: int
    n_gone: int
    n_kept: int


class MaskedCopy:
    """A masked copy in a folder: ``rows`` by run, a manifest for each version, and the commits."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.log = CommitLog(spark, f"{self.path}/commits")

    def _manifest(self, commit: dict | None) -> DataFrame:
        if commit is None:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifests/{commit['manifest']}")

    def read(self, version: int | None = None) -> DataFrame:
        """The masked rows of a version, the last one by default."""
        commit = self.log.last() if version is None else self.log.read(version)
        if commit is None:
            raise ValueError(f"nothing was copied to {self.path} yet")
        rows = self.spark.createDataFrame([], commit["schema"])
        if commit["folders"]:
            rows = self.spark.read.schema(commit["schema"]).parquet(*[f"{self.path}/rows/{f}" for f in commit["folders"]])
        return rows.drop(commit["file_column"])

    def follow(
        self,
        root: str,
        schema: str,
        columns: Mapping[str, str],
        left_out: Iterable[str] = (),
        files_at_once: int = FILES_AT_ONCE,
        source_format: str = "parquet",
        refresh: bool = False,
        **options,
    ) -> FollowRun:
        """Bring the copy up to the files that are under ``root`` now.

        ``schema`` is the source's, with the columns of its folders (``name=value``); ``columns`` maps masked
        columns to strategies, ``left_out`` are not copied, and ``options`` are those of ``mask_table``. Only
        rows of new files are read and masked. A version of a file is known by its
        path, size and time. Rows of files that are gone are dropped: the folders that hold some are written
        anew, as they are, without them. Other masks, columns or types than at the last run, or ``refresh``
        (a new key or vault), mask all files anew. A run that dies leaves the last version; what it wrote is in no
        version. Of two runs at a time one fails with ``CommitConflict``. A file that changes while
        it is read fails the run.
        """
        spark = self.spark
        last = self.log.last()
        hidden = {c.lower() for c in left_out}
        whole = spark.createDataFrame([], schema)
        shown = [c for c in whole.columns if c.lower() not in hidden]
        mark = free_name(whole.columns, "_file")
        masked_schema = mask_table(
            whole.select(*map(quote_ident, shown)).withColumn(mark, F.lit(0).cast("bigint")), columns, **options
        ).schema
        masks = json.dumps([sorted((c.lower(), s) for c, s in columns.items()), shown, masked_schema.jsonValue()], sort_keys=True)
        anew = refresh or last is None or last["masks"] != masks
        folder = uuid.uuid4().hex
        with work_area(spark):
            now = stored(source_files(spark, root), "files")
            twice = now.groupBy("file").count().filter("count > 1").first()
            if twice is not None:
                raise ValueError("two files have the same digest of path, size and time")
            before = self._manifest(None if anew else last)
            new = now.join(before.select("file"), "file", "left_anti")
            gone = before.join(now.select("file"), "file", "left_anti")
            n_new = self._mask(new, root, schema, shown, mark, columns, f"{self.path}/rows/{folder}", files_at_once, source_format, options)
            touched = [r["folder"] for r in gone.select("folder").distinct().collect()]  # folders of runs
            n_gone = gone.count() if touched else 0
            folders = [] if anew else [f for f in last["folders"] if f not in touched]
            kept = before.join(now.select("file"), "file", "left_semi")
            n_kept = kept.count()
            if not (n_new or n_gone or anew):
                return FollowRun(last["version"], 0, 0, n_kept)
            if n_new:
                folders.append(folder)
            manifest = new.select("path", "file", F.lit(folder).alias("folder"))
            if touched:
                rest = f"{folder}-rest"
                rows = spark.read.schema(masked_schema).parquet(*[f"{self.path}/rows/{f}" for f in touched])
                alive = kept.select(F.col("file").alias(mark))
                rows.join(alive, mark, "left_semi").select(*map(quote_ident, rows.columns)).write.parquet(f"{self.path}/rows/{rest}")
                folders.append(rest)
                kept = kept.withColumn("folder", F.when(F.col("folder").isin(touched), rest).otherwise(F.col("folder")))
            kept.unionByName(manifest).write.parquet(f"{self.path}/manifests/{folder}")
        content = {
            "manifest": folder, "folders": folders, "masks": masks, "file_column": mark,
            "schema": masked_schema.toDDL(),
        }
        version = 0 if last is None else last["version"] + 1
        self.log.add(version, content)
        return FollowRun(version, n_new, n_gone, n_kept)

    def _mask(self, new, root, schema, shown, mark, columns, out, files_at_once, source_format, options) -> int:
        """Write the masked rows of new files, ``files_at_once`` in a job; returns the number of files."""
        count = 0
        for paths in in_parts((r["path"] for r in new.toLocalIterator()), files_at_once):
            rows = self.spark.read.format(source_format).schema(schema).option("basePath", root).load(paths)
            rows = rows.select(*map(quote_ident, shown), file_id().alias(mark))
            mask_table(rows, columns, **options).write.mode("append").parquet(out)
            count += len(paths)
        if count:
            written = self.spark.read.parquet(out).select(F.col(mark).alias("file")).distinct()
            if not written.join(new, "file", "left_anti").isEmpty():
                raise ValueError("a source file changed while it was read")
        return count

    def drop_unused(self) -> int:
        """Delete the rows and manifests that the last version does not use; returns the number of folders. For times without a run."""
        last = self.log.last()
        used = {"rows": set(last["folders"]), "manifests": {last["manifest"]}} if last else {"rows": set(), "manifests": set()}
        dropped = 0
        files = self.spark._jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())
        for kind, keep in used.items():
            place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
            for status in files.listStatus(place) if files.exists(place) else ():
                if status.getPath().getName() not in keep:
                    drop_folder(self.spark, status.getPath().toString())
                    dropped += 1
        return dropped


def in_parts(values: Iterable[str], size: int) -> Iterator[list[str]]:
    rest = iter(values)
    while part := list(islice(rest, size)):
        yield part


def table_source(spark: SparkSession, name: str) -> tuple[str, str, str]:
    """Folder, format and schema of a catalog table made of files."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {quote_table(name)}")
    wanted = described.filter(F.col("col_name").isin("Location", "Provider")).collect()
    found = {r["col_name"]: r["data_type"] for r in wanted}
    if "Location" not in found:
        raise ValueError(f"{name} has no folder of files")
    return found["Location"], found.get("Provider", "parquet").lower(), spark.table(quote_table(name)).schema.toDDL()


@dataclass(frozen=True)
class FollowedTables:
    """``log`` has a row per column, ``runs`` what was done for each table."""

    log: DataFrame
    runs: dict[str, FollowRun]


def follow_control(
    spark: SparkSession,
    control: ControlTable,
    copy_path: Callable[[str], str],
    log_root: str,
    strategies: Mapping[str, str] | None = None,
    functions: Mapping[str, str] = MASK_FUNCTIONS,
    strict: bool = True,
    keep_unsupported: bool = False,
    **options,
) -> FollowedTables:
    """Bring the masked copies of all tables with flagged columns up to their sources' files.

    ``copy_path`` gives the folder of a table's ``MaskedCopy``. Columns of unsupported types are left out
    unless ``keep_unsupported``. What fails is logged and stops nothing; with ``strict`` it
    is raised at the end. Further options are those of ``MaskedCopy.follow``.
    """
    log_path = f"{log_root}/follow={uuid.uuid4().hex}"
    log = RunLog(spark, log_path)
    runs: dict[str, FollowRun] = {}
    for table, entries in by_table(mask_plan(control.flagged(), functions, strategies)):
        try:
            columns, rows, unmasked = sort_out(spark.table(quote_table(table)), entries, functions, keep_unsupported)
            if columns:
                root, source_format, schema = table_source(spark, table)
                runs[table] = MaskedCopy(spark, copy_path(table)).follow(
                    root, schema, columns, () if keep_unsupported else unmasked, source_format=source_format,
                    functions=functions, **options,
                )
        except Exception as error:
            rows = [(e["ColumnName"], "failed", str(error), e["strategy"]) for e in entries]
        log.add(table, rows)
    frame = log.read()
    if strict:
        raise_failures(frame, log_path)
    return FollowedTables(frame, runs)
