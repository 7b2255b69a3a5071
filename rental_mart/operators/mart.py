"""Default mart summaries over the DW fact (C11's summary argument)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rental_mart import functions as fx

T_DAILY = T.StructType([
    T.StructField("rent_dt", T.DateType()),
    T.StructField("n_groups", T.LongType()),
    T.StructField("n_stations", T.LongType()),
    T.StructField("use_cnt", T.LongType()),
    T.StructField("exer_amt", T.DoubleType()),
    T.StructField("carbon_amt", T.DoubleType()),
    T.StructField("move_meter", T.DoubleType()),
    T.StructField("move_time", T.LongType()),
    T.StructField("last_updated", T.TimestampNTZType()),
])

T_STATION = T.StructType([
    T.StructField("rent_dt", T.DateType()),
    T.StructField("rent_id", T.StringType()),
    T.StructField("rent_no", T.IntegerType()),
    T.StructField("rent_nm", T.StringType()),
    T.StructField("use_cnt", T.LongType()),
    T.StructField("exer_amt", T.DoubleType()),
    T.StructField("carbon_amt", T.DoubleType()),
    T.StructField("move_meter", T.DoubleType()),
    T.StructField("move_time", T.LongType()),
    T.StructField("last_updated", T.TimestampNTZType()),
])


def _measures():
    return [
        F.sum("use_cnt").alias("use_cnt"),
        F.sum("exer_amt").alias("exer_amt"),
        F.sum("carbon_amt").alias("carbon_amt"),
        F.sum("move_meter").alias("move_meter"),
        F.sum("move_time").alias("move_time"),
    ]


def daily_totals(dw: DataFrame) -> DataFrame:
    """Totals per day. ``n_stations`` is an exact distinct count; Spark plans it
    as a two-level (expand + partial) aggregation, never a per-day set."""
    return dw.groupBy("rent_dt").agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.count_distinct("rent_id").alias("n_stations"),
        *_measures(),
    )


def station_daily(dw: DataFrame) -> DataFrame:
    """Totals per day and station."""
    return dw.groupBy("rent_dt", "rent_id").agg(
        F.max("rent_no").alias("rent_no"),
        F.max("rent_nm").alias("rent_nm"),
        *_measures(),
    )
