"""Station dimension refresh driven by newly landed daily snapshots.

A file stream over the dimension's snapshot folders notices which
``snapshot_dt=`` days received files. Each micro-batch loads all of them in
order of date: guarded ODS reload from that day's snapshot, then upsert + soft
delete of the dimension (the same operators as the batch job). Loading a snapshot
again gives the same dimension, so a replayed micro-batch is harmless. The last
day loaded is kept next to the stream's checkpoint; a snapshot that lands later
for an older day is skipped with a warning, as it would roll the dimension back.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rental_mart.operators import tables as tb
from rental_mart.plans import station_load as sl
from rental_mart.sources import lake
from rental_mart.sources import ods as ods_src


def refresh_from_snapshot(spark: SparkSession, dim_base: str, service: str, row_schema: T.StructType,
                          snapshot_dt: str, ods: tb.ParquetTable, dw: tb.ParquetTable, load_ts=None) -> None:
    snap = lake.read_snapshot(spark, dim_base, service, row_schema, snapshot_dt)
    ods_src.load_ods_guarded(spark, snap, ods)
    sl.load_station_dw(spark, tb.read_table(spark, ods), dw, load_ts=load_ts)


def _last_day(spark: SparkSession, applied: str) -> str | None:
    if not tb.exists(spark, applied):
        return None
    return spark.read.schema("day string").parquet(applied).agg(F.max("day")).first()[0]


def start_station_refresh(spark: SparkSession, dim_base: str, service: str, row_schema: T.StructType,
                          ods: tb.ParquetTable, dw: tb.ParquetTable, checkpoint: str, load_ts=None,
                          available_now: bool = True) -> StreamingQuery:
    schema = T.StructType(list(row_schema.fields) + [T.StructField("snapshot_dt", T.StringType())])
    src = spark.readStream.schema(schema).parquet(f"{dim_base.rstrip('/')}/{service}").select("snapshot_dt")

    applied = f"{checkpoint.rstrip('/')}-applied"

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        # one row per landed day: bounded by the calendar, not by the data
        days = sorted(r["snapshot_dt"] for r in batch.distinct().collect())
        session = batch.sparkSession
        last = _last_day(session, applied)
        for day in days:
            if last is not None and day < last:
                warnings.warn(f"snapshot of {day} skipped: {last} is loaded already", stacklevel=2)
                continue
            refresh_from_snapshot(session, dim_base, service, row_schema, day, ods, dw, load_ts)
            session.createDataFrame([(day,)], "day string").write.mode("append").parquet(applied)
            last = day

    w = src.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 hour")
    return w.start()
