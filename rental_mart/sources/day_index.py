"""Which landed folders hold rows of which day.

A response is landed under the day it was asked for, but its rows may be dated otherwise. The index
is a small table beside the lake, one row for each (request day, rent day) with the number of rows,
partitioned by request day. A request day also carries a fingerprint of its folder's files (names,
sizes, modification times), so an update reads only the folders that changed since, and of them only
the date column. A pair that a folder no longer holds stays with 0 rows: whoever loaded the day from
it must load it again.

Files without a request day (the default partition) count as those of ``NO_DAY``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rental_mart import functions as fx
from rental_mart.operators import tables as tb
from rental_mart.sources import lake

NO_DAY = _dt.date(1900, 1, 1)
INDEX = T.StructType([
    T.StructField("rent_day", T.DateType()), T.StructField("n_rows", T.LongType()),
    T.StructField("fingerprint", T.LongType()), T.StructField("request_day", T.DateType()),
])
LOADED = T.StructType([T.StructField("fingerprint", T.LongType()), T.StructField("request_day", T.DateType())])


def index_table(fact_base: str, service: str) -> tb.ParquetTable:
    return tb.ParquetTable(f"{fact_base.rstrip('/')}/_day_index/{service}", INDEX, ("request_day",))


def _request_day(year: Column, month: Column, day: Column) -> Column:
    text = F.concat(year.cast("int"), F.lit("-"), month.cast("int"), F.lit("-"), day.cast("int"))
    return F.coalesce(F.try_to_timestamp(text, F.lit("y-M-d")).cast("date"), F.lit(NO_DAY))


def folders(spark: SparkSession, fact_base: str, service: str) -> DataFrame:
    """(request_day, fingerprint) of every landed day. Files are listed, not opened."""
    root = f"{fact_base.rstrip('/')}/{service}"
    if not tb.exists(spark, root):
        return spark.createDataFrame([], LOADED).select("request_day", "fingerprint")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(root)
    if not set(lake.DAY_PARTS) <= set(files.columns):  # nothing landed
        return spark.createDataFrame([], LOADED).select("request_day", "fingerprint")
    return files.groupBy(_request_day(*(F.col(c) for c in lake.DAY_PARTS)).alias("request_day")).agg(
        F.bit_xor(F.xxhash64("path", "modificationTime", "length")).alias("fingerprint"))


def changed_days(now: DataFrame, known: DataFrame) -> dict[_dt.date, int | None]:
    """Request days whose folder isn't as it was known, with the fingerprint that it has now (None
    where it is gone). One row for each changed day: bounded by the calendar, not by the data."""
    was = known.groupBy("request_day").agg(F.max("fingerprint").alias("was"))
    rows = now.join(was, "request_day", "full").where(~F.col("fingerprint").eqNullSafe(F.col("was"))).collect()
    return {r["request_day"]: r["fingerprint"] for r in rows}


def fingerprints(spark: SparkSession, days: dict[_dt.date, int | None]) -> DataFrame:
    return spark.createDataFrame([(v, k) for k, v in days.items()], LOADED)


def update(spark: SparkSession, fact_base: str, service: str, row_schema: T.StructType,
           date_col: str = "RENT_DT") -> tb.ParquetTable:
    """Bring the index up to the lake. Run after landing; run again after a failure it goes on from
    the folders themselves."""
    table = index_table(fact_base, service)
    tb.create_table(spark, table)
    known = tb.read_table(spark, table)
    days = changed_days(folders(spark, fact_base, service), known)
    if not days:
        return table
    only = T.StructType([f for f in row_schema.fields if f.name == date_col])
    rows = lake.read_request_days(spark, fact_base, service, only, [d for d, v in days.items() if v is not None], day_as="request_day")
    rent_day = F.try_to_timestamp(fx.compact_text(date_col), F.lit("yyyyMMdd")).cast("date")
    held = rows.groupBy("request_day", rent_day.alias("rent_day")).agg(F.count(F.lit(1)).alias("n_rows"))
    gone = known.where(F.col("request_day").isin(list(days))).select("request_day", "rent_day", F.lit(0).cast("long").alias("n_rows"))
    pairs = held.unionByName(gone).groupBy("request_day", "rent_day").agg(F.sum("n_rows").alias("n_rows"))
    # A folder without rows is known too.
    every = fingerprints(spark, days).join(pairs, "request_day", "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
    tb.refresh_days(spark, table, every, list(days), unique=True)
    return table


def rent_days_of(spark: SparkSession, table: tb.ParquetTable, request_days: list[_dt.date]) -> list[_dt.date]:
    """Days that rows of these folders are dated on, now or before: the days to load again when the
    folders change."""
    mine = tb.read_table(spark, table).where(F.col("request_day").isin(request_days) & F.col("rent_day").isNotNull())
    return sorted(r[0] for r in mine.select("rent_day").distinct().collect())


def holding(spark: SparkSession, table: tb.ParquetTable, first: _dt.date, last: _dt.date,
            rent_days: list[_dt.date] | None = None) -> list[_dt.date]:
    """Request days whose folders hold rows dated in [first, last] (of ``rent_days``, where given)."""
    rows = tb.read_table(spark, table).where((F.col("n_rows") > 0) & F.col("rent_day").between(F.lit(first), F.lit(last)))
    if rent_days is not None:
        rows = rows.where(F.col("rent_day").isin(rent_days))
    return sorted(r[0] for r in rows.select("request_day").distinct().collect())
