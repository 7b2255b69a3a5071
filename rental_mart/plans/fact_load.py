"""Period loads of the fact: ODS -> DW (C5) and DW -> DM (C11)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rental_mart import functions as fx
from rental_mart.operators import fact as fact_ops
from rental_mart.operators import mart as mart_ops
from rental_mart.operators import tables as tb
from rental_mart.schemas import DW_FACT, FACT_KEYS, FACT_VARCHAR_LIMITS
from rental_mart.session import require_ansi
from rental_mart.sources import day_index, lake
from rental_mart.sources import ods as ods_src
from rental_mart.sources import pages as pg


def dw_fact_table(path: str, name: str | None = None) -> tb.ParquetTable:
    return tb.ParquetTable(path, DW_FACT, ("rent_dt",), name=name, keys=FACT_KEYS,
                           limits=tuple(FACT_VARCHAR_LIMITS.items()))


def dm_daily_table(path: str, name: str | None = None) -> tb.ParquetTable:
    return tb.ParquetTable(path, mart_ops.T_DAILY, ("rent_dt",), name=name)


def dm_station_table(path: str, name: str | None = None) -> tb.ParquetTable:
    return tb.ParquetTable(path, mart_ops.T_STATION, ("rent_dt",), name=name)


def load_fact_dw(spark: SparkSession, ods: DataFrame, dw: tb.ParquetTable, start, end,
                 load_ts=None, variant: str = "iso") -> DataFrame:
    """Clean (B1 or B2) -> aggregate (C1) -> refresh the period (C4).
    Returns the DW row count (C10)."""
    require_ansi(spark)
    rows = fact_ops.fact_dw_rows(ods, start, end, variant=variant, load_ts=load_ts)
    tb.refresh_period(spark, dw, rows, start, end, unique=True)   # C1 groups by the key
    return tb.table_count(spark, dw)


def refresh_dm(spark: SparkSession, dw: tb.ParquetTable, dm: tb.ParquetTable, start, end,
               summary: Callable[[DataFrame], DataFrame] = mart_ops.daily_totals,
               load_ts=None) -> DataFrame:
    """C11: delete the period from the mart and insert ``summary`` of the DW
    rows of the period (the DW read prunes to the period's partitions)."""
    src = tb.read_period(spark, dw, start, end)
    rows = summary(src).withColumn("last_updated", fx.timestamp_literal(load_ts))
    tb.refresh_period(spark, dm, rows, start, end)
    return tb.table_count(spark, dm)


def run_fact_job(spark: SparkSession, landed_pages: DataFrame, row_schema, lake_base: str,
                 service: str, ods: tb.ParquetTable, dw: tb.ParquetTable, start, end,
                 load_ts=None, variant: str = "iso", ods_all_days: bool = True,
                 observation: Observation | None = None, refuse_truncated: bool = False) -> DataFrame:
    """The daily fact job end to end: unpack the landed responses of the period's
    request days (A1), land the rows by request day (A5), read them back (A9), lower-case
    (A10), reload the ODS (A12) and refresh the DW period (C5). Returns the DW count.

    An ODS table by request day (``ods.ods_fact_days_table``) gets only the days whose files
    changed, and the DW period is read from the request days that hold rows dated in it, by the
    day index. Any other ODS is a full refresh from every landed day; ``ods_all_days=False`` then
    reads the period's request days only and leaves an ODS of that period, in which a row that
    came with another request day is not found.

    ``observation`` and ``refuse_truncated`` are the landing gate of ``unpack_pages``: truncated
    responses are counted, or refused before any of the period's rows are landed."""
    s, e = fx.period_bounds(start, end)
    period_pages = landed_pages.where(
        F.col("rent_dt").between(F.lit(s.strftime("%Y%m%d")), F.lit(e.strftime("%Y%m%d"))))
    rows = pg.unpack_pages_fact(period_pages, row_schema, day_as="_request_day",
                                observation=observation, refuse_truncated=refuse_truncated)
    lake.land_fact(rows, lake_base, service, date_col="_request_day", keep_day=False)
    index = day_index.update(spark, lake_base, service, row_schema)
    if ods.partition_by:
        ods_src.load_ods_days(spark, lake_base, service, row_schema, ods)
        source = ods_src.read_ods_days(spark, ods, index, start, end)
        return load_fact_dw(spark, source, dw, start, end, load_ts=load_ts, variant=variant)
    landed = (lake.read_landed(spark, lake_base, service, row_schema) if ods_all_days
              else lake.read_landed(spark, lake_base, service, row_schema, start, end))
    ods_src.load_ods(spark, landed, ods)
    return load_fact_dw(spark, tb.read_table(spark, ods), dw, start, end, load_ts=load_ts, variant=variant)
