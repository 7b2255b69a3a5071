"""The lake: day-partitioned fact landing, daily dimension snapshots.

Layout (any Hadoop file-system URI works as a base, A11):
    <fact_base>/<service>/year=YYYY/month=MM/day=DD/part-*.parquet
    <dim_base>/<service>/snapshot_dt=YYYY-MM-DD/part-*.parquet
Partition values are zero-padded text; reads declare them as strings so no type
inference turns "01" into 1.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rental_mart import functions as fx
from rental_mart.operators import tables as tb

DAY_PARTS = ("year", "month", "day")


def date_spine(spark: SparkSession, start, end) -> DataFrame:
    """A4: every day of [start, end] as ``rent_dt`` text 'yyyyMMdd' (inclusive)."""
    s, e = fx.period_bounds(start, end)
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(s), F.lit(e), F.expr("INTERVAL 1 DAY"))).alias("d")
    ).select(F.date_format("d", "yyyyMMdd").alias("rent_dt"))


def date_spine_of(bounds: DataFrame, start_col: str = "start_dt", end_col: str = "end_dt") -> DataFrame:
    """A4 over data: one row per day between each row's date bounds."""
    days = F.sequence(F.col(start_col).cast("date"), F.col(end_col).cast("date"), F.expr("INTERVAL 1 DAY"))
    return bounds.select(F.explode(days).alias("d")).select(
        F.date_format("d", "yyyyMMdd").alias("rent_dt"))


def _service_root(base: str, service: str) -> str:
    return f"{base.rstrip('/')}/{service}"


def land_fact(rows: DataFrame, fact_base: str, service: str, date_col: str = "RENT_DT",
              rows_per_file: int | None = None, keep_day: bool = True) -> str:
    """Write rows under year=/month=/day= taken from the day text
    ('yyyyMMdd' or 'yyyy-MM-dd'). Re-landing a day replaces its files; days
    absent from ``rows`` are left as they are (dynamic partition overwrite).
    With the day that was asked for as ``date_col`` (``unpack_pages`` adds it) and
    ``keep_day=False``, a response goes whole to its request day, whatever dates
    its rows have or lack, and the added column is not written.
    ``rows_per_file`` caps rows per file; Spark's writer already streams rows,
    so memory stays bounded without it."""
    day = fx.compact_text(date_col)
    out = rows.select(
        "*",
        F.substring(day, 1, 4).alias("year"),
        F.substring(day, 5, 2).alias("month"),
        F.substring(day, 7, 2).alias("day"),
    ).drop(*([] if keep_day else [date_col])).hint("rebalance", *DAY_PARTS)
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if rows_per_file:
        w = w.option("maxRecordsPerFile", int(rows_per_file))
    root = _service_root(fact_base, service)
    w.partitionBy(*DAY_PARTS).parquet(root)
    return root


def read_landed(spark: SparkSession, fact_base: str, service: str, row_schema: T.StructType,
                start=None, end=None) -> DataFrame:
    """All landed rows of one service, stacked; partition keys are not
    returned. With a period, only the period's day folders are listed and read:
    they are passed to the reader directly (a lake of many years is not listed
    for a three-day load), and the partition filter stays as a guard."""
    root = _service_root(fact_base, service)
    schema = T.StructType(list(row_schema.fields) + [T.StructField(p, T.StringType()) for p in DAY_PARTS])
    if start is None and end is None:
        return spark.read.schema(schema).parquet(root).drop(*DAY_PARTS)
    s, e = fx.period_bounds(start or end, end or start)
    days = [s + _dt.timedelta(days=i) for i in range((e - s).days + 1)]
    folders = [f"{root}/year={d:%Y}/month={d:%m}/day={d:%d}" for d in days]
    present = [f for f in folders if tb.exists(spark, f)]
    if not present:
        return spark.createDataFrame([], row_schema)
    df = spark.read.schema(schema).option("basePath", root).parquet(*present)
    ymd = F.concat("year", "month", "day")
    df = df.where(ymd.between(F.lit(s.strftime("%Y%m%d")), F.lit(e.strftime("%Y%m%d"))))
    return df.drop(*DAY_PARTS)


def _day_folder(root: str, day: _dt.date) -> str:
    from rental_mart.sources.day_index import NO_DAY

    parts = ("__HIVE_DEFAULT_PARTITION__",) * 3 if day == NO_DAY else (f"{day:%Y}", f"{day:%m}", f"{day:%d}")
    return root + "".join(f"/{name}={value}" for name, value in zip(DAY_PARTS, parts))


def read_request_days(spark: SparkSession, fact_base: str, service: str, row_schema: T.StructType,
                      days: list[_dt.date], day_as: str | None = None) -> DataFrame:
    """A9 for named request days: only their folders are listed and read. ``day_as`` names a
    date column for the request day."""
    from rental_mart.sources.day_index import NO_DAY

    root = _service_root(fact_base, service)
    present = [f for f in (_day_folder(root, d) for d in days) if tb.exists(spark, f)]
    out = T.StructType(list(row_schema.fields) + ([T.StructField(day_as, T.DateType())] if day_as else []))
    if not present:
        return spark.createDataFrame([], out)
    schema = T.StructType(list(row_schema.fields) + [T.StructField(p, T.StringType()) for p in DAY_PARTS])
    df = spark.read.schema(schema).option("basePath", root).parquet(*present)
    if day_as:
        df = df.withColumn(day_as, F.coalesce(F.make_date(*(F.col(p).cast("int") for p in DAY_PARTS)), F.lit(NO_DAY)))
    return df.select(*out.fieldNames())


def land_snapshot(rows: DataFrame, dim_base: str, service: str, snapshot_dt) -> str:
    """The whole dimension as snappy Parquet under snapshot_dt=YYYY-MM-DD;
    a same-day rerun replaces that day only."""
    d = fx.iso_text(snapshot_dt if snapshot_dt is not None else _dt.date.today())
    root = _service_root(dim_base, service)
    # The day's folder is replaced as a whole, so an empty rerun leaves an empty day.
    (rows.drop("snapshot_dt").hint("rebalance")
         .write.mode("overwrite").option("compression", "snappy").parquet(f"{root}/snapshot_dt={d}"))
    return root


def read_snapshot(spark: SparkSession, dim_base: str, service: str, row_schema: T.StructType,
                  snapshot_dt) -> DataFrame:
    """One day's snapshot; ``snapshot_dt`` not returned. Only that day's
    folder is listed and read (empty when the day was never landed)."""
    d = fx.iso_text(snapshot_dt)
    root = _service_root(dim_base, service)
    folder = f"{root}/snapshot_dt={d}"
    if not tb.exists(spark, folder):
        return spark.createDataFrame([], row_schema)
    schema = T.StructType(list(row_schema.fields) + [T.StructField("snapshot_dt", T.StringType())])
    df = spark.read.schema(schema).option("basePath", root).parquet(folder)
    return df.where(F.col("snapshot_dt") == F.lit(d)).drop("snapshot_dt")


def lower_names(df: DataFrame) -> DataFrame:
    """A10: lower-case every column name; two names that collide are an error."""
    lowered = [c.lower() for c in df.columns]
    seen: dict[str, str] = {}
    for orig, low in zip(df.columns, lowered):
        if low in seen:
            raise ValueError(f"columns {seen[low]!r} and {orig!r} collide when lower-cased")
        seen[low] = orig
    return df.toDF(*lowered)
