"""Daily rental fact: cleaned projection (B1/B2) and the DW aggregate."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rental_mart import functions as fx
from rental_mart.schemas import FACT_KEYS


def cleaned_columns(date_col):
    """B3-B7 applied to the ODS text columns, with ``date_col`` as rent_dt."""
    return [
        date_col.alias("rent_dt"),
        F.col("rent_id"),
        F.col("rent_nm"),
        fx.rent_type("rent_type").alias("rent_type"),
        fx.gender("gender_cd").alias("gender_cd"),
        fx.age_type("age_type").alias("age_type"),
        fx.blank_int("use_cnt").alias("use_cnt"),
        fx.blank_double("exer_amt").alias("exer_amt"),
        fx.blank_double("carbon_amt").alias("carbon_amt"),
        fx.blank_double("move_meter").alias("move_meter"),
        fx.blank_int("move_time").alias("move_time"),
    ]


def clean_fact_iso(ods: DataFrame, start: str | _dt.date, end: str | _dt.date) -> DataFrame:
    """B1: keep rows whose text ``rent_dt`` lies in [start, end] compared as text on
    ISO bounds, then clean and cast. Compact dates ('20250101') never pass this
    text filter. The filter reaches the Parquet scan as a pushed predicate."""
    s, e = fx.period_bounds(start, end)
    kept = ods.where(F.col("rent_dt").between(F.lit(s.isoformat()), F.lit(e.isoformat())))
    return kept.select(*cleaned_columns(fx.iso_date("rent_dt")))


def clean_fact_any(ods: DataFrame, start: str | _dt.date, end: str | _dt.date) -> DataFrame:
    """B2: dates in 'yyyy-MM-dd' or 'yyyyMMdd'; the period filter compares the
    dash-stripped text with dash-stripped bounds."""
    s, e = fx.period_bounds(start, end)
    compact = fx.compact_text("rent_dt")
    kept = ods.where(compact.between(F.lit(s.strftime("%Y%m%d")), F.lit(e.strftime("%Y%m%d"))))
    return kept.select(*cleaned_columns(fx.any_date("rent_dt")))


def aggregate_fact(clean: DataFrame) -> DataFrame:
    """One row per (rent_dt, rent_id, rent_type, gender_cd, age_type).

    Station number and name are parsed from MAX(rent_nm) after the aggregate, so
    both come from the same raw name. Integer sums widen to bigint; double sums
    are plain double sums. Partial aggregation before the single
    exchange on the five keys keeps a hot station's rows from piling into one
    task."""
    agg = clean.groupBy(*FACT_KEYS).agg(
        F.max("rent_nm").alias("_max_nm"),
        F.sum("use_cnt").alias("use_cnt"),
        F.sum("exer_amt").alias("exer_amt"),
        F.sum("carbon_amt").alias("carbon_amt"),
        F.sum("move_meter").alias("move_meter"),
        F.sum("move_time").alias("move_time"),
    )
    return agg.select(
        "rent_dt", "rent_id",
        fx.station_number("_max_nm").alias("rent_no"),
        fx.station_name("_max_nm").alias("rent_nm"),
        "rent_type", "gender_cd", "age_type",
        "use_cnt", "exer_amt", "carbon_amt", "move_meter", "move_time",
    )


def with_audit(df: DataFrame, load_ts=None) -> DataFrame:
    """``created_at`` and ``last_updated`` = load_ts. The variant-A load does not
    name ``created_at``; the table's column default is the load time too."""
    ts = fx.timestamp_literal(load_ts)
    return df.withColumn("created_at", ts).withColumn("last_updated", ts)


def fact_dw_rows(ods: DataFrame, start, end, variant: str = "iso", load_ts=None) -> DataFrame:
    """B1/B2 -> C1 -> B14: the rows a period load inserts into the DW fact."""
    if variant == "iso":
        clean = clean_fact_iso(ods, start, end)
    elif variant == "any":
        clean = clean_fact_any(ods, start, end)
    else:
        raise ValueError(f"variant must be 'iso' or 'any', got {variant!r}")
    return with_audit(aggregate_fact(clean), load_ts)
