"""ODS layer: untouched text copies of the landed data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rental_mart.operators import tables as tb
from rental_mart import functions as fx
from rental_mart.schemas import ODS_FACT, ODS_STATION
from rental_mart.sources import day_index, lake
from rental_mart.sources.lake import lower_names


def ods_fact_table(path: str, name: str | None = None) -> tb.ParquetTable:
    return tb.ParquetTable(path, ODS_FACT, name=name)


def ods_fact_days_table(path: str, name: str | None = None) -> tb.ParquetTable:
    """The fact ODS partitioned by request day, for loads that follow the lake day by day."""
    return tb.ParquetTable(path, T.StructType([*ODS_FACT.fields, T.StructField("request_day", T.DateType())]), ("request_day",), name=name)


def ods_station_table(path: str, name: str | None = None) -> tb.ParquetTable:
    return tb.ParquetTable(path, ODS_STATION, name=name)


@dataclass(frozen=True)
class LoadStatus:
    table: str
    loaded: bool
    reason: str


def load_ods(spark: SparkSession, rows: DataFrame, table: tb.ParquetTable) -> LoadStatus:
    """Full refresh. Names are lower-cased, columns are matched by name and
    cast to the declared DDL (missing -> NULL, unknown -> error), then the table
    is replaced (staged, then swapped)."""
    tb.overwrite_table(spark, table, lower_names(rows))
    return LoadStatus(table.path, True, "reloaded")


def _loaded_table(table: tb.ParquetTable) -> tb.ParquetTable:
    """Which state of each request day the table was loaded from."""
    parent, name = tb._siblings(table)
    return tb.ParquetTable(f"{parent}/_{name}.loaded", day_index.LOADED, ("request_day",))


def load_ods_days(spark: SparkSession, fact_base: str, service: str, row_schema: T.StructType,
                  table: tb.ParquetTable) -> list:
    """A12 by day: request days whose files changed since the last load are replaced, the others
    are neither read nor written; the table then equals a full refresh. Returns the days. What was
    loaded is recorded behind the load, so a load that fails is done again."""
    loaded = _loaded_table(table)
    tb.create_table(spark, table)
    tb.create_table(spark, loaded)
    days = day_index.changed_days(day_index.folders(spark, fact_base, service), tb.read_table(spark, loaded))
    if days:
        rows = lake.read_request_days(spark, fact_base, service, row_schema, [d for d, v in days.items() if v is not None], day_as="request_day")
        tb.refresh_days(spark, table, lower_names(rows), list(days))
        tb.refresh_days(spark, loaded, day_index.fingerprints(spark, {d: v for d, v in days.items() if v is not None}), list(days))
    return sorted(days)


def read_ods_days(spark: SparkSession, table: tb.ParquetTable, index: tb.ParquetTable | None = None,
                  start=None, end=None) -> DataFrame:
    """The ODS rows of a table by day, without the request day. With an index and a period, only
    the request days that hold rows dated in it (a partition filter)."""
    rows = tb.read_table(spark, table)
    if index is not None:
        s, e = fx.period_bounds(start, end)
        rows = rows.where(F.col("request_day").isin(day_index.holding(spark, index, s, e)))
    return rows.drop("request_day")


def load_ods_guarded(spark: SparkSession, rows: DataFrame, table: tb.ParquetTable) -> LoadStatus:
    """Skip the reload when the input has no columns or no rows, leaving the
    previous ODS in place (the dimension's guard)."""
    if not rows.columns or rows.isEmpty():
        return LoadStatus(table.path, False, "empty input: previous table kept")
    return load_ods(spark, rows, table)


def preview(df: DataFrame, n: int = 5, order_by: list[str] | None = None) -> DataFrame:
    """The first rows; with ``order_by`` the first rows in that order (a
    top-k: each task keeps its best n, no full sort)."""
    return df.orderBy(*order_by).limit(n) if order_by else df.limit(n)


def shape(df: DataFrame) -> DataFrame:
    """(rows, columns) as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).alias("n_cols"))


def load_ods_jdbc(rows: DataFrame, schema, url: str, dbtable: str,
                  properties: dict[str, str] | None = None) -> None:
    """A12 into an external database: the same by-name, typed rows, written with
    Spark's JDBC writer as a full refresh that keeps the table definition
    (``truncate``). Needs the database's JDBC driver on the classpath; not
    exercised in this repository's tests (no database here)."""
    out = tb.conform(lower_names(rows), schema)
    (out.write.format("jdbc").option("url", url).option("dbtable", dbtable)
        .option("truncate", "true").options(**(properties or {})).mode("overwrite").save())
