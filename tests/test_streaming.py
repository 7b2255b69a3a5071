"""Incremental DW refresh from the landed lake equals the batch period load."""

from __future__ import annotations

import pytest

from pyspark.sql import functions as F

from rental_mart.operators import tables as tb
from rental_mart.plans import fact_load as fl
from rental_mart.schemas import FACT_API_ROW
from rental_mart.sources import derived as dv
from rental_mart.sources import lake
from rental_mart.streaming import landed_days

from conftest import SF001

OUT = ["rent_dt", "rent_id", "rent_no", "rent_nm", "rent_type", "gender_cd", "age_type",
       "use_cnt", "exer_amt", "carbon_amt", "move_meter", "move_time"]


def snapshot(spark, t):
    return sorted(tuple(r) for r in tb.read_table(spark, t).select(*OUT).collect())


def test_stream_equals_batch_and_replays_idempotently(spark, tmp_base):
    lake.land_fact(dv.fact_api_rows(spark, SF001), tmp_base, "svc")
    dw = fl.dw_fact_table(f"{tmp_base}/dw_stream")
    q = landed_days.start_dw_refresh(spark, tmp_base, "svc", FACT_API_ROW, dw, f"{tmp_base}/ckpt",
                                     load_ts=dv.LOAD_TS, max_files_per_trigger=7)
    q.awaitTermination()
    assert q.lastProgress is not None

    batch = fl.dw_fact_table(f"{tmp_base}/dw_batch")
    fl.load_fact_dw(spark, dv.ods_fact(spark, SF001), batch, "2024-01-01", "2024-01-31", load_ts=dv.LOAD_TS)
    assert snapshot(spark, dw) == snapshot(spark, batch)

    # replaying a batch (same days again) changes nothing
    landed_days.refresh_batch(spark, tmp_base, "svc", FACT_API_ROW, dw, ["2024-01-03", "2024-01-04"], dv.LOAD_TS)
    assert snapshot(spark, dw) == snapshot(spark, batch)

    # a new file for one day reloads only that day
    day = dv.fact_api_rows(spark, SF001).where(F.col("RENT_DT") == "2024-01-05")
    lake.land_fact(day.withColumn("USE_CNT", F.lit("100")), tmp_base, "svc")
    q = landed_days.start_dw_refresh(spark, tmp_base, "svc", FACT_API_ROW, dw, f"{tmp_base}/ckpt",
                                     load_ts=dv.LOAD_TS)
    q.awaitTermination()
    after = tb.read_table(spark, dw)
    changed = after.where(F.col("rent_dt") == F.lit("2024-01-05").cast("date"))
    assert changed.count() > 0 and changed.where(F.col("use_cnt") % 100 != 0).count() == 0
    others = sorted(tuple(r) for r in after.where(F.col("rent_dt") != F.lit("2024-01-05").cast("date"))
                    .select(*OUT).collect())
    assert others == [r for r in snapshot(spark, batch) if str(r[0]) != "2024-01-05"]


def test_snapshot_stream_loads_the_latest_day(spark, tmp_base):
    from rental_mart.operators import station as st
    from rental_mart.plans import station_load as sl
    from rental_mart.schemas import STATION_API_ROW
    from rental_mart.sources import ods
    from rental_mart.streaming import snapshots

    api = dv.station_api_rows(spark, SF001)
    dw = sl.dw_station_table(f"{tmp_base}/dw_station")
    o = ods.ods_station_table(f"{tmp_base}/ods_station")
    lake.land_snapshot(api.where(F.col("stationId").endswith("3")), tmp_base, "st", "2024-01-01")
    q = snapshots.start_station_refresh(spark, tmp_base, "st", STATION_API_ROW, o, dw, f"{tmp_base}/ck",
                                        load_ts="2024-01-01 00:00:00")
    q.awaitTermination()
    first = st.active_count(tb.read_table(spark, dw)).first().n_active
    lake.land_snapshot(api, tmp_base, "st", "2024-01-02")
    q = snapshots.start_station_refresh(spark, tmp_base, "st", STATION_API_ROW, o, dw, f"{tmp_base}/ck",
                                        load_ts="2024-01-02 00:00:00")
    q.awaitTermination()
    assert first == api.where(F.col("stationId").endswith("3")).count()
    assert st.active_count(tb.read_table(spark, dw)).first().n_active == api.count()
    # replaying the last day changes nothing
    before = sorted(tuple(r) for r in tb.read_table(spark, dw).collect())
    snapshots.refresh_from_snapshot(spark, tmp_base, "st", STATION_API_ROW, "2024-01-02", o, dw,
                                    load_ts="2024-01-02 00:00:00")
    assert sorted(tuple(r) for r in tb.read_table(spark, dw).collect()) == before


def test_null_date_folder_is_reported_and_skipped(spark):
    from rental_mart.streaming import landed_days

    batch = spark.createDataFrame([("2024", "01", "05"), (None, None, None), ("__HIVE_DEFAULT_PARTITION__", "", "")], "year string, month string, day string")
    with pytest.warns(UserWarning, match="without a date"):
        assert landed_days._days_of(batch) == ["2024-01-05"]


def test_empty_snapshot_rerun_replaces_the_day(spark, tmp_base):
    from pyspark.sql import types as T

    from rental_mart.sources import lake

    schema = T.StructType([T.StructField("stationid", T.StringType())])
    lake.land_snapshot(spark.createDataFrame([("ST-1",)], schema), tmp_base, "st", "2024-01-01")
    lake.land_snapshot(spark.createDataFrame([("ST-2",)], schema), tmp_base, "st", "2024-01-02")
    lake.land_snapshot(spark.createDataFrame([], schema), tmp_base, "st", "2024-01-01")
    assert lake.read_snapshot(spark, tmp_base, "st", schema, "2024-01-01").count() == 0
    assert lake.read_snapshot(spark, tmp_base, "st", schema, "2024-01-02").count() == 1
