"""Apply masks to table data."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from datetime import datetime, timezone
from itertools import groupby
from threading import Lock

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from colmask import schemas
from colmask.functions.names import base_type, free_name, quote_ident, quote_table
from colmask.functions.nested import OMIT, is_nested, leaves, masked_sql, path_part, paths
from colmask.functions.redact import (
    MASK_FUNCTIONS,
    UnsupportedTypeError,
    shown_sql,
)
from colmask.functions.sql import ACCESS_GROUP, granted_sql
from colmask.operators.planning import name_lines
from colmask.operators.tokens import tokenize
from colmask.session import work_area
from colmask.sources.versions import Vault


def mask_table(
    df: DataFrame,
    columns: Mapping[str, str] | Iterable[str],
    authorized: bool | Column = False,
    key: str | Column | None = None,
    functions: Mapping[str, str] = MASK_FUNCTIONS,
    vault: DataFrame | None = None,
) -> DataFrame:
    """``df`` as a reader sees it, with the given columns masked.

    ``columns`` lists names or maps names to strategies; names compare without
    case. A name may be the path of a field inside a struct, array or map, see ``colmask.functions.nested``; that
    of a container with ``.*`` stands for all fields in it. Masked columns are STRING, all others are as stored. It is one
    projection: no shuffle, native expressions only, and a query that leaves
    masked columns out does not read them. Works on streams too.

    ``authorized`` may be a column, e.g. ``has_grant(grants)``. Pass the
    ``key`` of hashes as a scalar subquery (``keys.scalar()``) to keep it out
    of plans and event logs; a literal shows up in both. Only the ``token``
    strategy joins, with a ``vault`` that has all values (see
    ``extend_vault``); it is for copies, not for views.
    """
    wanted = _by_path(df.schema, columns)
    _check_columns(df, wanted, functions)
    tokens = [f.name for f in df.schema.fields if wanted.get(path_part(f.name).lower()) == "token"]
    if sum(strategy == "token" for strategy in wanted.values()) > len(tokens):
        raise ValueError("the token strategy is for whole columns")
    if tokens and (vault is None or authorized is not False):
        raise ValueError("the token strategy needs a vault and makes copies only")
    schema = df.schema
    if tokens:
        df = tokenize(df, tokens, vault)

    # Lookups become columns of their own, so they are made once for all masks.
    lookups = []
    if isinstance(authorized, Column):
        name = free_name(df.columns, "_authorized")
        lookups.append(authorized.alias(name))
        authorized = quote_ident(name)
    if key is not None:
        name = free_name(df.columns, "_key")
        lookups.append((F.lit(key) if isinstance(key, str) else key).alias(name))
        key = quote_ident(name)
    if lookups:
        df = df.select("*", *lookups)

    tokened = {path_part(name).lower() for name in tokens}
    masks = {path: strategy for path, strategy in wanted.items() if path not in tokened}
    return df.selectExpr(*_projection(schema, masks, authorized, key, functions))


def _projection(schema, wanted, authorized, key, functions) -> list[str]:
    """The columns of ``schema`` as SQL, with the fields at the ``wanted`` paths masked."""

    def shown(value: str, dtype: str, strategy: str) -> str:
        return shown_sql(value, dtype, authorized, strategy, key, functions)

    selected = []
    for field in schema.fields:
        ident = quote_ident(field.name)
        sql = masked_sql(ident, field.dataType, path_part(field.name), wanted, shown)
        if sql is not None:
            selected.append(ident if sql == ident else f"{sql} AS {ident}")
    return selected


def _by_path(schema, columns: Mapping[str, str] | Iterable[str]) -> dict[str, str]:
    """Strategy by lowercase path; the name of a column counts as its path."""
    names = {field.name.lower(): path_part(field.name).lower() for field in schema.fields}
    return {names.get(name, name): strategy for name, strategy in _by_lower_name(columns).items()}


def _by_lower_name(columns: Mapping[str, str] | Iterable[str]) -> dict[str, str]:
    """Strategy by lowercase column name."""
    if isinstance(columns, Mapping):
        return {name.lower(): strategy for name, strategy in columns.items()}
    return {name.lower(): "redact" for name in columns}


def _check_columns(df: DataFrame, wanted: Mapping[str, str], functions: Mapping[str, str]) -> None:
    known = {path.lower(): (path, dtype) for path, dtype in paths(df.schema)}
    whole = {f"{path}.*" for path, (_, dtype) in known.items() if is_nested(dtype)}
    missing = sorted(set(wanted) - set(known) - whole)
    if missing:
        raise ValueError(f"no such column: {', '.join(missing)}")

    def strategy_of(path: str, dtype: DataType) -> str | None:
        if path in wanted or is_nested(dtype):
            return wanted.get(path)
        around = [p for p in wanted if p.endswith(".*") and path.startswith(p[:-1])]
        return wanted[max(around, key=len)] if around else None

    bad = [
        path
        for lower, (path, dtype) in known.items()
        if strategy_of(lower, dtype) not in (None, OMIT) and base_type(dtype.simpleString()) not in functions
    ]
    if bad:
        raise UnsupportedTypeError(f"Unsupported data type(s) encountered for: {'; '.join(bad)}")


def write_masked(
    df: DataFrame,
    columns: Mapping[str, str] | Iterable[str],
    path: str,
    partition_by: Iterable[str] = (),
    mode: str = "errorifexists",
    **options,
) -> None:
    """Write a masked copy as parquet, the form to publish where readers reach files."""
    wanted = _by_lower_name(columns)
    masked_keys = set(wanted) & {c.lower() for c in partition_by}
    if masked_keys:
        raise ValueError(f"masked columns cannot name folders: {', '.join(sorted(masked_keys))}")
    writer = mask_table(df, wanted, **options).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def create_masked_view(
    spark: SparkSession,
    view: str,
    table: str,
    columns: Mapping[str, str] | Iterable[str],
    grants_table: str,
    group: str = ACCESS_GROUP,
    temporary: bool = True,
    functions: Mapping[str, str] = MASK_FUNCTIONS,
    key: str | None = None,
    left_out: Iterable[str] = (),
    closure_table: str | None = None,
) -> str:
    """A view over ``table`` that masks by who reads it; returns its SQL.

    The reader is looked up in ``grants_table`` (principal, grp), and in ``closure_table`` for groups inside groups, once per
    query, so the view follows the grants and the table's rows. ``key`` is the SQL of a scalar subquery
    with the key of hashes, e.g. ``(SELECT key FROM gov.keys)``. Columns ``left_out`` are not in the
    view. Tokens need a copy. A view is no barrier for someone who
    can read the files; give those readers a masked copy instead.
    """
    source = spark.table(quote_table(table))
    wanted = _by_path(source.schema, columns)
    _check_columns(source, wanted, functions)
    hidden = {c.lower() for c in left_out}
    granted, secret = free_name(source.columns, "_authorized"), free_name(source.columns, "_key")
    wanted |= {path_part(c).lower(): OMIT for c in source.columns if c.lower() in hidden}
    secret_ident = None if key is None else quote_ident(secret)
    selected = _projection(source.schema, wanted, quote_ident(granted), secret_ident, functions)
    looked_up = f"{granted_sql(grants_table, group, closure_table)} AS {quote_ident(granted)}"
    if key is not None:
        looked_up += f", {key} AS {quote_ident(secret)}"
    sql = (
        f"CREATE OR REPLACE {'TEMPORARY ' if temporary else ''}VIEW {quote_table(view)} AS "
        f"SELECT {', '.join(selected)} FROM (SELECT *, {looked_up} FROM {quote_table(table)})"
    )
    spark.sql(sql)
    return sql


class MaskRunError(ValueError):
    """Columns of a run failed; ``log`` is its log and ``messages`` the folder that lists them all."""

    def __init__(self, text: str, log: DataFrame, messages: str):
        super().__init__(text)
        self.log = log
        self.messages = messages


def by_table(plan: DataFrame) -> Iterator[tuple[str, list[Row]]]:
    """The plan's entries table by table, without holding the plan."""
    if "due" not in plan.columns:
        plan = plan.withColumn("due", F.lit(True))
    ordered = plan.orderBy("TableName", "ColumnName").toLocalIterator()
    for table, entries in groupby(ordered, key=lambda r: r["TableName"]):
        yield table, list(entries)


class RunLog:
    """The log of a run: a new table that grows every ``batch`` tables."""

    def __init__(self, spark: SparkSession, path: str, batch: int = 100):
        self.spark, self.path, self.batch = spark, path, batch
        self.at = datetime.now(timezone.utc)
        self.rows: list[tuple] = []
        self.tables = 0
        spark.createDataFrame([], schemas.MASK_LOG).write.parquet(path)

    def add(self, table: str, entries: Iterable[tuple]) -> None:
        self.rows += [(table, *entry, self.at) for entry in entries]
        self.tables += 1
        if self.tables % self.batch == 0:
            self._save()

    def _save(self) -> None:
        if self.rows:
            self.spark.createDataFrame(self.rows, schemas.MASK_LOG).write.mode("append").parquet(self.path)
            self.rows.clear()

    def read(self) -> DataFrame:
        self._save()
        return self.spark.read.schema(schemas.MASK_LOG).parquet(self.path)


def mask_all(
    spark: SparkSession,
    plan: DataFrame,
    read: Callable[[str], DataFrame],
    write: Callable[[str, DataFrame], None],
    log_path: str,
    strict: bool = True,
    keep_unsupported: bool = False,
    key: str | Column | None = None,
    functions: Mapping[str, str] = MASK_FUNCTIONS,
    vault: Vault | None = None,
    batch: int = 100,
    writers: int = 4,
) -> DataFrame:
    """Write masked copies of the tables of a plan; returns the log, one row per column.

    The plan must list all flagged columns of a table, as its write replaces
    an earlier copy. A table is written if a column that can be masked is due (see ``mark_due``;
    without that column in the plan all are): a column of an unsupported type,
    or one that is gone, is reported each time but writes nothing. Each table is one write on
    the executors, and ``writers`` tables are written at a time, so that small
    tables do not leave the cluster idle. The driver
    walks through the plan table by table; the log is a new table at ``log_path`` that grows
    every ``batch`` tables. What fails is logged and stops
    nothing; with ``strict`` a ``MaskRunError`` is raised once
    all others are done. Columns of unsupported types are left out of the
    copies unless ``keep_unsupported`` lets them through as they are.
    """
    log = RunLog(spark, log_path, batch)
    one_at_a_time = Lock()

    def run(table: str, entries: list[Row]) -> list[tuple]:
        try:
            df = read(table)
            columns, entries_log, unmasked = sort_out(df, entries, functions, keep_unsupported)
            if any(e["due"] for e in entries if columns.get(e["ColumnName"], OMIT) != OMIT):
                masked = _masked_copy(df, columns, () if keep_unsupported else unmasked, key, functions, vault, one_at_a_time)
                write(table, masked)
                return entries_log
            due = {e["ColumnName"] for e in entries if e["due"]}
            return [e for e in entries_log if e[0] in due]
        except Exception as error:
            return [(e["ColumnName"], "failed", str(error), e["strategy"]) for e in entries]

    with ThreadPoolExecutor(writers) as pool:
        running: dict[Future, str] = {}
        for table, entries in by_table(plan):
            running[pool.submit(run, table, entries)] = table
            while len(running) > writers:
                for done in wait(running, return_when=FIRST_COMPLETED).done:
                    log.add(running.pop(done), done.result())
        for done in list(running):
            log.add(running.pop(done), done.result())
    frame = log.read()
    if strict:
        raise_failures(frame, log_path)
    return frame


def sort_out(df: DataFrame, entries: list[Row], functions: Mapping[str, str], keep_unsupported: bool = False):
    """Strategy by column that can be masked, (column, status, error, strategy) of each entry, and the unsupported columns.

    Fields of unsupported types inside a column are not among those: they get the strategy that leaves them out, unless
    ``keep_unsupported``.
    """
    types = {leaf.path.lower(): base_type(leaf.dtype) for leaf in leaves(df.schema)}
    types |= {name.lower(): base_type(dtype) for name, dtype in df.dtypes}
    plain = {name.lower() for name in df.columns}
    columns, unmasked, log = {}, set(), []
    for entry in entries:
        name, strategy = entry["ColumnName"], entry["strategy"]
        dtype = types.get(name.lower())
        if dtype is None:
            log.append((name, "failed", "no such column", strategy))
        elif entry["status"] == "unsupported" or dtype not in functions:
            shown = entry["DataType"] if entry["status"] == "unsupported" else dtype
            if name.lower() in plain:
                unmasked.add(name.lower())
            elif not keep_unsupported:
                columns[name] = OMIT
            log.append((name, "failed", f"Unsupported data type: {shown}", strategy))
        else:
            columns[name] = strategy
            log.append((name, "success", None, strategy))
    return columns, log, unmasked


def _masked_copy(df, columns, left_out, key, functions, vault, one_at_a_time):
    df = df.select(*[quote_ident(c) for c in df.columns if c.lower() not in left_out])
    tokens = None
    named = [name for name, strategy in columns.items() if strategy == "token"]
    if named:
        if vault is None:
            raise ValueError("the token strategy needs a vault")
        with one_at_a_time:
            vault.add(df, named)
            tokens = vault.read()
    return mask_table(df, columns, key=key, functions=functions, vault=tokens)


def raise_failures(log: DataFrame, log_path: str) -> None:
    """Raise a ``MaskRunError`` if columns failed, however many there are.

    Its text has their numbers and names a folder beside the log that lists
    all of them, in lines of bounded length (``kind, line, n_columns, message``).
    """
    failed = log.filter(F.col("status") == "failed")
    kind = F.col("error").startswith("Unsupported data type")
    counts = failed.agg(F.count(F.lit(1)).alias("all"), F.count_if(kind).alias("types")).first()
    if counts["all"] == 0:
        return
    folder, _, name = log_path.rstrip("/").rpartition("/")
    messages = f"{folder}/messages-{name}"
    with work_area(log.sparkSession):
        lists = [
            name_lines(failed.filter(of_kind)).select(F.lit(text).alias("kind"), "*")
            for text, of_kind in (("Unsupported data type(s) encountered for", kind), ("Failed for other reasons", ~kind))
        ]
        lists[0].unionByName(lists[1]).write.mode("overwrite").parquet(messages)
    raise MaskRunError(
        f"{counts['types']} column(s) of unsupported type and {counts['all'] - counts['types']} other failure(s); "
        f"all are listed in {messages}",
        log,
        messages,
    )


def applied_columns(mask_log: DataFrame) -> DataFrame:
    """Columns that the latest write of their table masked, with the strategy.

    Earlier writes do not count: a copy is replaced as a whole, so a column that was not flagged any more at the
    latest write is in it as it is.
    """
    done = mask_log.filter(F.col("status") == "success")
    latest = done.groupBy(F.col("TableName").alias("_table")).agg(F.max("at").alias("_at"))
    same = (F.col("TableName") == F.col("_table")) & (F.col("at") == F.col("_at"))
    return done.join(latest, same, "left_semi").select("TableName", "ColumnName", "strategy").distinct()
