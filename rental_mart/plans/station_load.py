"""Station dimension load (C8): upsert then soft delete, one load time, one write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rental_mart.operators import station as st
from rental_mart.operators import tables as tb
from rental_mart.schemas import DW_STATION
from rental_mart.session import require_ansi
from rental_mart.sources import lake
from rental_mart.sources import ods as ods_src
from rental_mart.sources import pages as pg


def dw_station_table(path: str, name: str | None = None) -> tb.ParquetTable:
    return tb.ParquetTable(path, DW_STATION, name=name)


def station_rows(target: DataFrame, ods_station: DataFrame, load_ts=None) -> DataFrame:
    """C6 then C7 over the same cleaned source and the same load time, in one join."""
    return st.merge_station(target, st.clean_station(ods_station), load_ts, delete_missing=True)


def load_station_dw(spark: SparkSession, ods_station: DataFrame, dw: tb.ParquetTable,
                    load_ts=None) -> DataFrame:
    """Compute the new dimension from the current one and rewrite it (staged,
    then swapped). Returns the active count (C9)."""
    require_ansi(spark)
    tb.create_table(spark, dw)
    current = tb.read_table(spark, dw)
    tb.overwrite_table(spark, dw, station_rows(current, ods_station, load_ts))
    return st.active_count(tb.read_table(spark, dw))


def run_station_job(spark: SparkSession, landed_pages: DataFrame, row_schema, lake_base: str,
                    service: str, snapshot_dt, ods: tb.ParquetTable, dw: tb.ParquetTable,
                    load_ts=None) -> DataFrame:
    """The daily dimension job end to end: unpack the landed responses with the
    dimension's stop rule (A2), land the day's snapshot (A7), read it back (A8),
    reload the ODS unless the snapshot is empty (A13), then upsert and soft
    delete (C8). The DW step runs on the current ODS either way. Returns the
    active count (C9)."""
    rows = pg.unpack_pages_dim(landed_pages, row_schema)
    lake.land_snapshot(rows, lake_base, service, snapshot_dt)
    snap = lake.read_snapshot(spark, lake_base, service, row_schema, snapshot_dt)
    ods_src.load_ods_guarded(spark, snap, ods)
    return load_station_dw(spark, tb.read_table(spark, ods), dw, load_ts=load_ts)
