"""Scans that classify only what has changed since the last one."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colmask import schemas
from colmask.operators.changes import changed_tables, column_changes, columns_of, out_of_reach
from colmask.operators.discover import classify_columns, classify_fields
from colmask.operators.rules import EXCLUDED_SUFFIXES, Rule, default_rules
from colmask.session import drop_folder, stored, work_folder
from colmask.sources.commits import CommitConflict
from colmask.sources.inventory import catalog_tables, write_inventory
from colmask.sources.versions import ControlTable, VersionedTable


class Snapshot(VersionedTable):
    """The inventory of the last scan, and under which rules and into which control table it was classified."""

    def __init__(self, spark: SparkSession, path: str, nested: bool = False):
        super().__init__(spark, path, schemas.FIELDS if nested else schemas.COLUMNS)
        self.nested = nested
        last = self._commit()
        if last is not None and last["nested"] != nested:
            raise ValueError(f"{self.path} was made {'with' if last['nested'] else 'without'} nested fields")

    def mark(self) -> str | None:
        last = self._commit()
        return None if last is None else last["mark"]

    def replace(self, columns: DataFrame, mark: str) -> int:
        """Make ``columns`` the snapshot. Of two scans at a time the later one stays, whose columns are classified as well."""
        while True:
            try:
                return self._write(columns, self._commit(), mark=mark, nested=self.nested)
            except CommitConflict:
                continue


@dataclass(frozen=True)
class Rescan:
    """``changes`` has a row per column that is not as before, ``n_tables`` is how many tables were classified.

    ``log`` is that of the scan, if there was one.
    """

    changes: DataFrame
    n_tables: int
    log: DataFrame | None = None


def _mark(control: ControlTable, rules: Sequence[Rule] | DataFrame | None) -> str:
    """A digest of what else decides on the matches."""
    if isinstance(rules, DataFrame):
        row = F.xxhash64(*[F.col(c) for c in ("prio", "keyword", "mode", "string_only")])
        known = tuple(rules.agg(F.count(F.lit(1)), F.bit_xor(row), F.sum(F.shiftright(row, 32))).first())
    else:
        known = tuple(map(repr, default_rules() if rules is None else rules))
    return hashlib.sha256(repr((control.path, known, EXCLUDED_SUFFIXES)).encode()).hexdigest()


def discover_changes(
    spark: SparkSession,
    control: ControlTable,
    snapshot: Snapshot,
    columns: DataFrame,
    rules: Sequence[Rule] | DataFrame | None = None,
    keep_flag: bool = True,
    failed: DataFrame | None = None,
    full: bool = False,
) -> Rescan:
    """Bring the control table up to an inventory, by the tables that differ from the snapshot.

    ``columns`` is read several times, so pass a written table. The control table is as after a scan of
    everything, but for rows that were taken out of it by hand: those of a table that is as before do not come back. Other
    rules, another control table or ``full`` classify every table. Rows of dropped columns stay in the control table and are in ``changes``.
    ``failed`` names the units (tables, schemas, catalogs) that could not be read: what they cover counts as unchanged.
    The control table is changed before the snapshot, so a run that dies in between is made good by the next.
    """
    mark = _mark(control, rules)
    anew = full or snapshot.mark() != mark
    before = snapshot.read()
    differ = stored(changed_tables(columns, before), "changed")
    unread = spark.createDataFrame([], "TableName string")
    if failed is not None:
        unread = stored(out_of_reach(differ.filter("change = 'dropped'"), failed), "unread")
        differ = differ.join(unread, "TableName", "left_anti")
    changes = stored(column_changes(columns_of(columns, differ), columns_of(before, differ)), "changes")
    present = differ.filter("change <> 'dropped'")
    due = columns if anew else columns_of(columns, present)
    n_tables = columns.select("TableName").distinct().count() if anew else present.count()
    if n_tables:
        control.add(classify_fields(due, rules) if snapshot.nested else classify_columns(due, rules), keep_flag)
    if anew or not differ.isEmpty():
        kept = columns_of(before, unread) if failed is not None else before.limit(0)
        snapshot.replace(columns.unionByName(kept), mark)
    return Rescan(changes, n_tables)


def rescan_catalog(
    spark: SparkSession,
    control: ControlTable,
    snapshot: Snapshot,
    rules: Sequence[Rule] | DataFrame | None = None,
    keep_flag: bool = True,
    names: Iterable[str] | None = None,
    full: bool = False,
) -> Rescan:
    """``discover_catalog`` that classifies only tables whose columns are not those of the snapshot.

    The catalog is asked for every table's columns all the same. ``names`` must be those of every table the snapshot is to hold.
    """
    if names is None:
        names = catalog_tables(spark)
    path = work_folder(spark, "inventory")
    columns, log = write_inventory(spark, names, path, nested=snapshot.nested)
    failed = log.filter("status = 'failed'")
    run = discover_changes(spark, control, snapshot, columns, rules, keep_flag, failed, full)
    drop_folder(spark, f"{path}/columns")
    return Rescan(run.changes, run.n_tables, log)
