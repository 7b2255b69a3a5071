"""Landing, snapshots, ODS loads (A4-A14) and the layout profile."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rental_mart.operators import quality as dq
from rental_mart.operators import tables as tb
from rental_mart.schemas import FACT_API_ROW, STATION_API_ROW
from rental_mart.sources import derived as dv
from rental_mart.sources import lake, ods

from conftest import SF001


def test_date_spine_inclusive(spark):
    got = [r.rent_dt for r in lake.date_spine(spark, "2024-02-27", "20240302").collect()]
    assert got == ["20240227", "20240228", "20240229", "20240301", "20240302"]


def test_lower_names_collision(spark):
    df = spark.createDataFrame([(1, 2)], "A int, b int")
    assert lake.lower_names(df).columns == ["a", "b"]
    with pytest.raises(ValueError):
        lake.lower_names(spark.createDataFrame([(1, 2)], "`Ab` int, `aB` int"))


def test_relanding_replaces_days_and_keeps_absent_ones(spark, tmp_base):
    rows = dv.fact_api_rows(spark, SF001)
    lake.land_fact(rows, tmp_base, "svc")
    n_all = lake.read_landed(spark, tmp_base, "svc", FACT_API_ROW).count()
    one_day = rows.where(F.col("RENT_DT") == "2024-01-05").limit(3)
    lake.land_fact(one_day, tmp_base, "svc")
    back = lake.read_landed(spark, tmp_base, "svc", FACT_API_ROW)
    assert back.where(F.col("RENT_DT") == "2024-01-05").count() == 3
    n_day = rows.where(F.col("RENT_DT") == "2024-01-05").count()
    assert back.count() == n_all - n_day + 3
    assert set(back.columns) == set(FACT_API_ROW.fieldNames())


def test_partition_values_stay_zero_padded(spark, tmp_base):
    lake.land_fact(dv.fact_api_rows(spark, SF001), tmp_base, "svc")
    schema = T.StructType(FACT_API_ROW.fields + [T.StructField(c, T.StringType()) for c in ("year", "month", "day")])
    raw = spark.read.schema(schema).parquet(f"{tmp_base}/svc")
    assert {r.month for r in raw.select("month").distinct().collect()} == {"01"}


def test_snapshot_days_are_separate(spark, tmp_base):
    api = dv.station_api_rows(spark, SF001)
    lake.land_snapshot(api.limit(2), tmp_base, "st", "2024-01-01")
    lake.land_snapshot(api, tmp_base, "st", "2024-01-02")
    lake.land_snapshot(api.limit(1), tmp_base, "st", "2024-01-01")  # same-day rerun replaces
    assert lake.read_snapshot(spark, tmp_base, "st", STATION_API_ROW, "2024-01-01").count() == 1
    assert lake.read_snapshot(spark, tmp_base, "st", STATION_API_ROW, "2024-01-02").count() == api.count()
    assert lake.read_snapshot(spark, tmp_base, "st", STATION_API_ROW, "2024-01-03").count() == 0


def test_ods_reload_and_guard(spark, tmp_base):
    t = ods.ods_station_table(f"{tmp_base}/ods_station")
    rows = dv.station_api_rows(spark, SF001)
    assert ods.load_ods_guarded(spark, rows, t).loaded
    n = tb.read_table(spark, t).count()
    assert not ods.load_ods_guarded(spark, rows.limit(0), t).loaded
    assert not ods.load_ods_guarded(spark, spark.range(3).select(), t).loaded
    assert tb.read_table(spark, t).count() == n
    ods.load_ods(spark, rows.limit(4), t)
    assert tb.read_table(spark, t).count() == 4


def test_shape_and_preview(spark):
    li = dv.table(spark, SF001, "lineitem")
    r = ods.shape(li).first()
    assert (r.n_rows, r.n_cols) == (li.count(), len(li.columns))
    assert ods.preview(li).count() == 5


def test_rows_per_file_and_layout(spark, tmp_base):
    rows = dv.fact_api_rows(spark, SF001)
    lake.land_fact(rows, tmp_base, "svc", rows_per_file=10)
    prof = dq.layout_profile(spark, f"{tmp_base}/svc").collect()
    assert sum(r.n_rows for r in prof) == rows.count()
    per_day = {r.RENT_DT: r.n for r in rows.groupBy("RENT_DT").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert all(r.n_files >= -(-r.n_rows // 10) for r in prof)
    assert len(prof) == len(per_day)


def test_period_read_lists_only_the_period(spark, tmp_base):
    import re

    lake.land_fact(dv.fact_api_rows(spark, SF001), tmp_base, "svc")
    df = lake.read_landed(spark, tmp_base, "svc", FACT_API_ROW, "2024-01-10", "2024-01-12")
    files = df.inputFiles()
    assert files and all(re.search(r"day=1[0-2]/", f) for f in files)
    empty = lake.read_landed(spark, tmp_base, "svc", FACT_API_ROW, "2023-01-01", "2023-01-05")
    assert empty.count() == 0 and empty.columns == FACT_API_ROW.fieldNames()
