"""Warehouse tables as Parquet folders, and their DML.

A table is a folder, a declared schema and optional partition columns. Every
write goes to a hidden staging folder first, so a failed job leaves the table
as it was and a rerun is idempotent. A period refresh is decided by one rename
(``_staging-*`` becomes ``_ready-*``, which names every day it replaces); days
are then moved in one by one, and if the driver dies meanwhile the next writer
goes on from where it stopped. Until then readers may miss the day being moved.
Readers skip names starting with ``_``.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rental_mart import functions as fx


@dataclass(frozen=True)
class ParquetTable:
    path: str
    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    name: str | None = None   # optional catalog name, e.g. "dw.fact_rent_daily"
    keys: tuple[str, ...] = ()   # primary key: not NULL, unique (checked by loads)
    limits: tuple[tuple[str, int], ...] = ()   # VARCHAR lengths (checked by loads)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]


# ---- optional catalog registration (SQL access by name) ------------------------------

def _quoted(ident: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in ident.split("."))


def register_table(spark: SparkSession, table: ParquetTable) -> None:
    """C12 in Spark DDL: CREATE SCHEMA IF NOT EXISTS + an external Parquet table over
    the folder, so SQL can use the table by name."""
    if not table.name:
        return
    if "." in table.name:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_quoted(table.name.rsplit('.', 1)[0])}")
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields)
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in table.partition_by)})" if table.partition_by else ""
    location = table.path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_quoted(table.name)} ({cols}) USING parquet{parts} "
              f"LOCATION '{location}'")
    sync_catalog(spark, table)


def sync_catalog(spark: SparkSession, table: ParquetTable) -> None:
    """After files changed underneath a registered table: re-list its partitions
    (added and removed) or drop its cached file listing."""
    if not table.name:
        return
    if table.partition_by:
        spark.sql(f"MSCK REPAIR TABLE {_quoted(table.name)} SYNC PARTITIONS")
    else:
        spark.sql(f"REFRESH TABLE {_quoted(table.name)}")


# ---- file-system helpers (metadata only; data never passes the driver) --------------

def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def _mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def _rename(spark: SparkSession, src: str, dst: str) -> None:
    fs, s = _fs(spark, src)
    if not fs.rename(s, _path(spark, dst)):
        raise OSError(f"rename failed: {src} -> {dst}")


def _children(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    return [(n, d) for n, d, _ in _children_status(spark, path)]


def _children_status(spark: SparkSession, path: str) -> list[tuple[str, bool, int]]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return _status(fs.listStatus(p))


def _glob(spark: SparkSession, pattern: str) -> list[tuple[str, bool, int]]:
    """Entries matching a glob; the file system filters, so a folder with many
    entries costs one call, not one per entry."""
    fs, p = _fs(spark, pattern)
    return _status(fs.globStatus(p) or [])


def _status(statuses) -> list[tuple[str, bool, int]]:
    return [(st.getPath().getName(), bool(st.isDirectory()), int(st.getModificationTime()))
            for st in statuses]


def _hidden(name: str) -> bool:
    return name.startswith("_") or name.startswith(".")


# ---- C12: create / drop ------------------------------------------------------------

def _siblings(table: ParquetTable) -> tuple[str, str]:
    root = table.path.rstrip("/")
    return root.rsplit("/", 1) if "/" in root else (".", root)


def recover(spark: SparkSession, table: ParquetTable) -> None:
    """Undo a swap interrupted by a driver failure. Called by writers before they
    write (one writer per table is assumed; readers never move files). If the
    table folder is missing but a previous version was parked beside it, the
    newest parked version is put back; leftover staging folders are removed; a
    period refresh that was decided but not finished is finished."""
    parent, name = _siblings(table)
    left = _glob(spark, f"{parent}/_{name}.staging-*") + _glob(spark, f"{parent}/_{name}.old-*")
    if not exists(spark, table.path):
        parked = sorted((t, n) for n, d, t in left if d and n.startswith(f"_{name}.old-"))
        if parked:
            _rename(spark, f"{parent}/{parked[-1][1]}", table.path)
    for n, _, _ in left:
        if exists(spark, f"{parent}/{n}"):
            _delete(spark, f"{parent}/{n}")
    root = table.path.rstrip("/")
    for n, d, _ in _glob(spark, f"{root}/_staging-*"):
        _delete(spark, f"{root}/{n}")
    for n, d, _ in _glob(spark, f"{root}/_ready-*"):
        _publish(spark, table, f"{root}/{n}")
        sync_catalog(spark, table)


def create_table(spark: SparkSession, table: ParquetTable, replace: bool = False) -> ParquetTable:
    """CREATE SCHEMA IF NOT EXISTS + (DROP TABLE IF EXISTS when ``replace``) + CREATE TABLE."""
    recover(spark, table)
    fs, p = _fs(spark, table.path)
    if replace and fs.exists(p):
        fs.delete(p, True)
    fs.mkdirs(p)
    register_table(spark, table)
    return table


def drop_table(spark: SparkSession, table: ParquetTable) -> None:
    if table.name:
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(table.name)}")
    _delete(spark, table.path)


def read_table(spark: SparkSession, table: ParquetTable) -> DataFrame:
    """Read with the declared schema (partition values typed by it, no inference)."""
    return spark.read.schema(table.schema).parquet(table.path).select(*table.columns)


def read_period(spark: SparkSession, table: ParquetTable, start, end) -> DataFrame:
    """B12 read: rows with the partition date in [start, end]. The period's
    partition folders are handed to the reader directly, so only they are listed
    (one existence check per day); the predicate stays as a guard."""
    s, e = fx.period_bounds(start, end)
    present = [_partition_dir(table, d) for d in _days(s, e)]
    present = [p for p in present if exists(spark, p)]
    if not present:
        return spark.createDataFrame([], table.schema)
    df = spark.read.schema(table.schema).option("basePath", table.path).parquet(*present)
    col = table.partition_by[0]
    return df.where(F.col(col).between(F.lit(s), F.lit(e))).select(*table.columns)


def table_count(spark: SparkSession, table: ParquetTable) -> DataFrame:
    """COUNT(*) as a one-row DataFrame."""
    return read_table(spark, table).agg(F.count(F.lit(1)).alias("n_rows"))


# ---- shaping rows for a table ------------------------------------------------------

def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """INSERT ... BY NAME: pick the table's columns by name, cast to their types;
    columns the input lacks become NULL; unknown input columns are an error."""
    known = {f.name for f in schema.fields}
    extra = [c for c in df.columns if c not in known]
    if extra:
        raise ValueError(f"columns not in the target table: {extra}")
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def _checked(df: DataFrame, table: ParquetTable) -> DataFrame:
    """The table's NOT NULL and VARCHAR constraints, raised while rows are written."""
    limits = dict(table.limits)
    out = df
    for c in dict.fromkeys([*table.keys, *limits]):
        if c in table.keys:
            out = out.withColumn(c, F.coalesce(F.col(c), F.raise_error(F.lit(f"NULL in {c}")).cast(table.schema[c].dataType)))
        if c in limits:
            long = F.raise_error(F.lit(f"more than {limits[c]} characters in {c}")).cast("string")
            out = out.withColumn(c, F.when(F.length(c) > limits[c], long).otherwise(F.col(c)))
    return out


def _rows_of_days(spark: SparkSession, table: ParquetTable, days: list[_dt.date]) -> DataFrame:
    return read_table(spark, table).where(F.col(table.partition_by[0]).isin(days))


def _refuse_repeated_keys(spark: SparkSession, table: ParquetTable, staged: str, with_table: bool) -> None:
    """Primary key: no key twice among the staged rows, nor one that the table already has. The
    partition column is part of the key, so only the staged days are read (a partition filter)."""
    if not table.keys:
        return
    new = spark.read.schema(table.schema).parquet(staged)
    if not new.groupBy(*table.keys).count().filter("count > 1").isEmpty():
        raise ValueError(f"rows repeat a primary key of {table.path}")
    if not with_table:
        return
    prefix = f"{table.partition_by[0]}="
    days = [_dt.date.fromisoformat(n.removeprefix(prefix)) for n, is_dir in _children(spark, staged) if is_dir and n.startswith(prefix)]
    there = _rows_of_days(spark, table, days) if table.partition_by[0] in table.keys else read_table(spark, table)
    if not there.join(new, list(table.keys), "left_semi").isEmpty():
        raise ValueError(f"rows hold primary keys that {table.path} already has")


def _write(df: DataFrame, table: ParquetTable, path: str, mode: str) -> None:
    out = _checked(conform(df, table.schema), table)
    if table.partition_by:
        # AQE rebalance: about one file per partition value, hot values split.
        out = out.hint("rebalance", *table.partition_by)
        out.write.mode(mode).partitionBy(*table.partition_by).parquet(path)
    else:
        out.write.mode(mode).parquet(path)


# ---- C3: append -------------------------------------------------------------------

def append_rows(spark: SparkSession, table: ParquetTable, rows: DataFrame) -> None:
    """INSERT INTO table (cols) SELECT ... by name. Rows that break the table's
    declared constraints raise, and nothing is inserted."""
    if table.keys and len(table.partition_by) == 1:
        _refresh(spark, table, rows, [], inserts=True)
        return
    create_table(spark, table)
    _write(rows, table, table.path, "append")
    sync_catalog(spark, table)


# ---- full refresh (ODS reload, dimension rewrite) ----------------------------------

def overwrite_table(spark: SparkSession, table: ParquetTable, rows: DataFrame) -> None:
    """Replace the whole table. Rows may be computed from the table itself: they are
    written to a sibling staging folder before the old folder is removed."""
    recover(spark, table)
    parent, name = _siblings(table)
    tag = uuid.uuid4().hex[:12]
    staging = f"{parent}/_{name}.staging-{tag}"
    backup = f"{parent}/_{name}.old-{tag}"
    _write(rows, table, staging, "overwrite")
    had_old = exists(spark, table.path)
    if had_old:
        _rename(spark, table.path, backup)
    _rename(spark, staging, table.path)
    if had_old:
        _delete(spark, backup)
    if table.name:
        register_table(spark, table)


# ---- C2 / C4: period delete and refresh ---------------------------------------------

def delete_period(df: DataFrame, start, end, date_col: str = "rent_dt") -> DataFrame:
    """C2 as a keep-filter: rows with ``date_col`` in [start, end] go; rows whose
    date is NULL stay (``NOT coalesce(p, false)``)."""
    s, e = fx.period_bounds(start, end)
    in_period: Column = F.col(date_col).between(F.lit(s), F.lit(e))
    return df.where(~F.coalesce(in_period, F.lit(False)))


def _days(s: _dt.date, e: _dt.date) -> list[_dt.date]:
    return [s + _dt.timedelta(days=i) for i in range((e - s).days + 1)]


def refresh_period(spark: SparkSession, table: ParquetTable, rows: DataFrame, start, end, unique: bool = False) -> None:
    """C4: delete the period, then insert ``rows`` -- rerunnable.

    1. write ``rows`` partitioned into ``<table>/_staging-*`` (the expensive part;
       a failure here leaves the table untouched);
    2. name every day of [start, end] in the staging folder, an empty one where the
       day got no rows, and decide the refresh by renaming it ``_ready-*``;
    3. day by day, remove the old partition folder and move the new one in (dates
       outside the period are added as INSERT would). The table is never listed.
    ``unique``: the rows are known to hold each primary key once (grouped by it).
    """
    s, e = fx.period_bounds(start, end)
    _refresh(spark, table, rows, _days(s, e), unique=unique)


def refresh_days(spark: SparkSession, table: ParquetTable, rows: DataFrame, days, unique: bool = False) -> None:
    """C4 for a set of days instead of one range (used by incremental loads)."""
    _refresh(spark, table, rows, sorted({_dt.date.fromisoformat(fx.iso_text(d)) for d in days}), unique=unique)


def _partition_dir(table: ParquetTable, day: _dt.date) -> str:
    # Spark writes a DATE partition value as ISO text
    return f"{table.path.rstrip('/')}/{table.partition_by[0]}={day.isoformat()}"


def _refresh(spark: SparkSession, table: ParquetTable, rows: DataFrame, clear_days: list[_dt.date],
             inserts: bool = False, unique: bool = False) -> None:
    if len(table.partition_by) != 1:
        raise ValueError("a period refresh needs a table partitioned by one date column")
    create_table(spark, table)
    root = table.path.rstrip("/")
    tag = uuid.uuid4().hex[:12]
    staging, ready = f"{root}/_staging-{tag}", f"{root}/_ready-{tag}"
    _write(rows, table, staging, "overwrite")
    if not unique:
        _refuse_repeated_keys(spark, table, staging, with_table=inserts)
    # Days of the period without new rows are staged as empty folders; days outside it are added to.
    cleared = {_partition_dir(table, d).rsplit("/", 1)[1] for d in clear_days}
    staged = {n for n, is_dir in _children(spark, staging) if is_dir and not _hidden(n)}
    for name in cleared - staged:
        _mkdirs(spark, f"{staging}/{name}")
    for name in staged - cleared:
        _mkdirs(spark, f"{staging}/{_ADDED}")
        _rename(spark, f"{staging}/{name}", f"{staging}/{_ADDED}/{name}")
    _rename(spark, staging, ready)   # from here on the refresh is decided
    _publish(spark, table, ready)
    sync_catalog(spark, table)


_ADDED = "_added"


def _publish(spark: SparkSession, table: ParquetTable, ready: str) -> None:
    """Move a decided refresh in. What is done is no longer in ``ready``, so after a
    failure the same call goes on with the rest."""
    root = table.path.rstrip("/")
    for name, is_dir in _children(spark, ready):
        if is_dir and not _hidden(name):
            _delete(spark, f"{root}/{name}")
            if _children(spark, f"{ready}/{name}"):
                _rename(spark, f"{ready}/{name}", f"{root}/{name}")
    for name, _ in _children(spark, f"{ready}/{_ADDED}"):
        if not exists(spark, f"{root}/{name}"):
            _rename(spark, f"{ready}/{_ADDED}/{name}", f"{root}/{name}")
            continue
        for file, is_dir in _children(spark, f"{ready}/{_ADDED}/{name}"):
            if not is_dir and not _hidden(file):
                _rename(spark, f"{ready}/{_ADDED}/{name}/{file}", f"{root}/{name}/{file}")
    _delete(spark, ready)


def register_view(spark: SparkSession, name: str, table: ParquetTable) -> str:
    """Expose a table to SQL under ``name`` (a temporary view over its folder)."""
    read_table(spark, table).createOrReplaceTempView(name)
    return name
