"""Incremental DW refresh driven by newly landed fact files.

The batch load refreshes one period at a time. Here a file stream over the
lake notices which request days received new files. The day index tells which
days the rows of those folders are dated on, now or before, and which folders
hold rows of those days: a late row lies in another day's response. Each
micro-batch reloads exactly those days from exactly those folders through the
same clean -> aggregate -> refresh operators. The refresh is idempotent, so a
micro-batch replayed after a failure (the stream's checkpoint records it as not
committed) gives the same table.
"""

from __future__ import annotations

import datetime as dt
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rental_mart.operators import fact as fact_ops
from rental_mart.operators import tables as tb
from rental_mart.sources import day_index, lake


def _touched(batch: DataFrame) -> list[list[str | None]]:
    # one row per touched day folder: bounded by the calendar, not by the data
    return [list(r) for r in batch.select(*lake.DAY_PARTS).distinct().collect()]


def _dated(folder: list[str | None]) -> bool:
    return all(x and x.isdigit() for x in folder)


def _days_of(batch: DataFrame) -> list[str]:
    """Touched request days as ISO text. Files in the default partition belong to none, which is
    reported: of their rows, those with a date of their own reach the DW."""
    folders = _touched(batch)
    dated = [f for f in folders if _dated(f)]
    if len(dated) < len(folders):
        warnings.warn("rows were landed without a date to land them by", stacklevel=2)
    return sorted("-".join(f) for f in dated)


def refresh_batch(spark: SparkSession, fact_base: str, service: str, row_schema: T.StructType,
                  dw: tb.ParquetTable, request_days: list[str | dt.date], load_ts=None, variant: str = "iso") -> None:
    """Reload the DW days that rows of the given request days are or were dated on, each
    from all the folders that hold it. A request day that holds no row of itself has its own DW
    day reloaded, too."""
    if not request_days:
        return
    touched = [d if isinstance(d, dt.date) else dt.date.fromisoformat(d) for d in request_days]
    index = day_index.update(spark, fact_base, service, row_schema)
    days = sorted({*day_index.rent_days_of(spark, index, touched), *(d for d in touched if d != day_index.NO_DAY)})
    if not days:
        return
    folders = day_index.holding(spark, index, days[0], days[-1], days)
    landed = lake.read_request_days(spark, fact_base, service, row_schema, folders)
    rows = fact_ops.fact_dw_rows(lake.lower_names(landed), days[0], days[-1], variant=variant, load_ts=load_ts)
    rows = rows.where(F.col("rent_dt").isin(days))
    tb.refresh_days(spark, dw, rows, days, unique=True)


def start_dw_refresh(spark: SparkSession, fact_base: str, service: str, row_schema: T.StructType,
                     dw: tb.ParquetTable, checkpoint: str, load_ts=None,
                     available_now: bool = True, max_files_per_trigger: int | None = None,
                     variant: str = "iso") -> StreamingQuery:
    """Start the stream. ``available_now`` processes everything landed so far and
    stops (a scheduled job); otherwise it keeps watching the lake."""
    schema = T.StructType(list(row_schema.fields) + [T.StructField(p, T.StringType()) for p in lake.DAY_PARTS])
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    src = reader.parquet(f"{fact_base.rstrip('/')}/{service}").select(*lake.DAY_PARTS)

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        undated = [] if all(map(_dated, _touched(batch))) else [day_index.NO_DAY]
        refresh_batch(batch.sparkSession, fact_base, service, row_schema, dw, [*_days_of(batch), *undated], load_ts, variant)

    w = src.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
