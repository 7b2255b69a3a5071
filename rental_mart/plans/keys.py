"""Registered queries: key -> (spark, sf_dir) -> DataFrame.

Stateless keys are lazy DataFrames. Stateful keys (writes, refreshes, upserts)
run their writes under a fresh folder of the shared checkpoint location and
return the re-read table, so the write path is what gets compared.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rental_mart.operators import fact as fact_ops
from rental_mart.operators import mart as mart_ops
from rental_mart.operators import quality as dq
from rental_mart.operators import station as st_ops
from rental_mart.operators import tables as tb
from rental_mart.plans import fact_load as fl
from rental_mart.plans import sql_templates
from rental_mart.plans import station_load as sl
from rental_mart.schemas import DW_FACT, FACT_API_ROW, STATION_API_ROW
from rental_mart.session import scratch_path
from rental_mart.sources import derived as dv
from rental_mart.sources import day_index, lake, ods, pages
from rental_mart.streaming import landed_days, snapshots

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}

OUT_FACT = ["rent_dt", "rent_id", "rent_no", "rent_nm", "rent_type", "gender_cd", "age_type",
            "use_cnt", "exer_amt", "carbon_amt", "move_meter", "move_time"]


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


# ---- B / C1: clean and aggregate ---------------------------------------------------

@register("fact_clean_iso")
def fact_clean_iso(spark, sf_dir):
    return fact_ops.clean_fact_iso(dv.ods_fact(spark, sf_dir), *dv.PERIOD)


@register("fact_clean_any")
def fact_clean_any(spark, sf_dir):
    return fact_ops.clean_fact_any(dv.ods_fact_mixed(spark, sf_dir), *dv.PERIOD)


@register("fact_dw_daily")
def fact_dw_daily(spark, sf_dir):
    clean = fact_ops.clean_fact_iso(dv.ods_fact(spark, sf_dir), *dv.PERIOD)
    return fact_ops.aggregate_fact(clean)


@register("fact_dw_daily_any")
def fact_dw_daily_any(spark, sf_dir):
    clean = fact_ops.clean_fact_any(dv.ods_fact_mixed(spark, sf_dir), *dv.PERIOD)
    return fact_ops.aggregate_fact(clean)


@register("fact_dw_daily_iso_on_mixed")
def fact_dw_daily_iso_on_mixed(spark, sf_dir):
    """Variant A over mixed date text keeps only the dashed half."""
    clean = fact_ops.clean_fact_iso(dv.ods_fact_mixed(spark, sf_dir), *dv.PERIOD)
    return fact_ops.aggregate_fact(clean)


# ---- C2-C5, C10, C11: period loads into partitioned tables ---------------------------


def _loaded_dw(spark, sf_dir, name: str) -> tb.ParquetTable:
    """DW fact loaded over the wide period, then the test period reloaded."""
    dw = fl.dw_fact_table(scratch_path(spark, name))
    ods_rows = dv.ods_fact(spark, sf_dir)
    fl.load_fact_dw(spark, ods_rows, dw, *dv.WIDE_PERIOD, load_ts=dv.LOAD_TS)
    fl.load_fact_dw(spark, ods_rows, dw, *dv.PERIOD, load_ts=dv.LOAD_TS)
    return dw


@register("fact_refresh_period")
def fact_refresh_period(spark, sf_dir):
    """C4 twice equals once: reloading a period inside a loaded range changes nothing."""
    dw = _loaded_dw(spark, sf_dir, "fact_refresh_period")
    return tb.read_table(spark, dw).select(*OUT_FACT)


@register("fact_refresh_lost_day")
def fact_refresh_lost_day(spark, sf_dir):
    """A reload where one day lost all its source rows leaves that day empty."""
    dw = fl.dw_fact_table(scratch_path(spark, "fact_refresh_lost_day"))
    fl.load_fact_dw(spark, dv.ods_fact(spark, sf_dir), dw, *dv.WIDE_PERIOD, load_ts=dv.LOAD_TS)
    fl.load_fact_dw(spark, dv.ods_fact_without_day(spark, sf_dir), dw, *dv.PERIOD, load_ts=dv.LOAD_TS)
    return tb.read_table(spark, dw).select(*OUT_FACT)


@register("fact_insert")
def fact_insert(spark, sf_dir):
    """Append a second period's rows by name to a loaded table."""
    dw = fl.dw_fact_table(scratch_path(spark, "fact_insert"))
    ods_rows = dv.ods_fact(spark, sf_dir)
    fl.load_fact_dw(spark, ods_rows, dw, *dv.EARLY_PERIOD, load_ts=dv.LOAD_TS)
    tb.append_rows(spark, dw, fact_ops.fact_dw_rows(ods_rows, *dv.PERIOD, load_ts=dv.LOAD_TS))
    return tb.read_table(spark, dw).select(*OUT_FACT)


@register("table_count")
def table_count(spark, sf_dir):
    """COUNT(*) of the DW fact of all days after the loads."""
    return tb.table_count(spark, _whole_dw(spark, sf_dir, "table_count"))


def _whole_dw(spark, sf_dir, name: str) -> tb.ParquetTable:
    """DW fact of every date that the source holds, then the test period reloaded."""
    dw = fl.dw_fact_table(scratch_path(spark, name))
    ods_rows = dv.ods_fact(spark, sf_dir)
    tb.append_rows(spark, dw, fact_ops.fact_dw_rows(ods_rows, *dv.ALL_DATES, load_ts=dv.LOAD_TS))
    fl.load_fact_dw(spark, ods_rows, dw, *dv.PERIOD, load_ts=dv.LOAD_TS)
    return dw


@register("fact_dw_audit")
def fact_dw_audit(spark, sf_dir):
    """The DW of all days with its audit columns, ``created_at`` included."""
    return tb.read_table(spark, _whole_dw(spark, sf_dir, "fact_dw_audit"))


@register("fact_dw_by_name")
def fact_dw_by_name(spark, sf_dir):
    """C12 and B15 through the session catalog: create the schema and the table, insert the rows
    of a source bound by name into a target bound by name, read it by name, drop it."""
    name = f"rental_key_{uuid.uuid4().hex[:12]}.fact_rent_daily"
    dw = fl.dw_fact_table(scratch_path(spark, "fact_dw_by_name"), name=name)
    tb.create_table(spark, dw, replace=True)
    source = f"_ods_{uuid.uuid4().hex}"
    dv.ods_fact(spark, sf_dir).createOrReplaceTempView(source)
    rows = fact_ops.with_audit(sql_templates.fact_dw_sql(spark, source, *dv.ALL_DATES), dv.LOAD_TS)
    sql_templates.insert_by_name(spark, name, rows)
    # Rows are re-read from the folder once the name is gone.
    out = spark.table(name).agg(F.count("*").alias("by_name")).first()["by_name"]
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"DROP SCHEMA {name.split('.')[0]}")
    spark.catalog.dropTempView(source)
    return tb.read_table(spark, dw).withColumn("by_name", F.lit(out).cast("long"))


def _loaded_dm(spark, sf_dir, name, make_table, summary):
    dw = _loaded_dw(spark, sf_dir, f"{name}_dw")
    dm = make_table(scratch_path(spark, f"{name}_dm"))
    fl.refresh_dm(spark, dw, dm, *dv.WIDE_PERIOD, summary=summary, load_ts=dv.LOAD_TS)
    fl.refresh_dm(spark, dw, dm, *dv.PERIOD, summary=summary, load_ts=dv.LOAD_TS)
    return tb.read_table(spark, dm).drop("last_updated")


@register("mart_daily")
def mart_daily(spark, sf_dir):
    return _loaded_dm(spark, sf_dir, "mart_daily", fl.dm_daily_table, mart_ops.daily_totals)


@register("mart_station")
def mart_station(spark, sf_dir):
    return _loaded_dm(spark, sf_dir, "mart_station", fl.dm_station_table, mart_ops.station_daily)


# ---- B8-B11, B13, C6-C9: station dimension --------------------------------------------

@register("station_clean")
def station_clean(spark, sf_dir):
    return st_ops.clean_station(dv.ods_station(spark, sf_dir))


@register("station_upsert")
def station_upsert(spark, sf_dir):
    src = st_ops.clean_station(dv.ods_station(spark, sf_dir))
    return st_ops.upsert_station(dv.dw_station_seed(spark, sf_dir), src, dv.LOAD_TS)


@register("station_soft_delete")
def station_soft_delete(spark, sf_dir):
    src = st_ops.clean_station(dv.ods_station(spark, sf_dir))
    return st_ops.soft_delete_missing(dv.dw_station_seed(spark, sf_dir), src, dv.LOAD_TS)


@register("station_soft_delete_null_key")
def station_soft_delete_null_key(spark, sf_dir):
    """A NULL code in the source turns NOT IN into NULL for every row: nothing is deleted."""
    src = st_ops.clean_station(dv.ods_station(spark, sf_dir, null_key_every=10))
    return st_ops.soft_delete_missing(dv.dw_station_seed(spark, sf_dir), src, dv.LOAD_TS)


def _loaded_station(spark, sf_dir, name):
    dw = sl.dw_station_table(scratch_path(spark, name))
    tb.overwrite_table(spark, dw, dv.dw_station_seed(spark, sf_dir))
    count = sl.load_station_dw(spark, dv.ods_station(spark, sf_dir), dw, load_ts=dv.LOAD_TS)
    return dw, count


@register("station_load")
def station_load(spark, sf_dir):
    dw, _ = _loaded_station(spark, sf_dir, "station_load")
    return tb.read_table(spark, dw)


@register("station_active_count")
def station_active_count(spark, sf_dir):
    _, count = _loaded_station(spark, sf_dir, "station_active_count")
    return count


# ---- A1-A14, D7: pages, lake, ODS ------------------------------------------------------


FACT_SERVICE = "rent_daily"
DIM_SERVICE = "station_list"
SNAPSHOT_DAY = "2024-02-01"
EMPTY_SNAPSHOT_DAY = "2024-02-02"


def _landed_lake(spark, sf_dir, name):
    base = scratch_path(spark, name)
    lake.land_fact(dv.fact_api_rows(spark, sf_dir), base, FACT_SERVICE)
    return base


@register("land_fact_readback")
def land_fact_readback(spark, sf_dir):
    base = _landed_lake(spark, sf_dir, "land_fact_readback")
    return lake.read_landed(spark, base, FACT_SERVICE, FACT_API_ROW)


@register("land_fact_period_readback")
def land_fact_period_readback(spark, sf_dir):
    """Period read: only the period's day folders are listed and scanned."""
    base = _landed_lake(spark, sf_dir, "land_fact_period_readback")
    return lake.read_landed(spark, base, FACT_SERVICE, FACT_API_ROW, *dv.PERIOD)


@register("land_relanding")
def land_relanding(spark, sf_dir):
    """Re-landing the period replaces those days; other days stay as landed."""
    base = _landed_lake(spark, sf_dir, "land_relanding")
    lost = dv.ods_fact_without_day(spark, sf_dir)
    period = lost.where(F.col("rent_dt").between(*dv.PERIOD))
    lake.land_fact(period.select(*[F.col(c).alias(c.upper()) for c in period.columns]), base, FACT_SERVICE)
    return lake.read_landed(spark, base, FACT_SERVICE, FACT_API_ROW)


@register("land_by_request_day")
def land_by_request_day(spark, sf_dir):
    """One day's response holds a late row of another day and a row without a date: both go
    to the request day, the other day's folder stays, and the ODS misses no row."""
    base = _landed_lake(spark, sf_dir, "land_by_request_day")
    rnum = F.col("RNUM").cast("long")
    day = dv.fact_api_rows(spark, sf_dir).where(F.col("RENT_DT") == dv.PERIOD[0]).withColumn(
        "RENT_DT", F.when(rnum % 10 == 0, F.lit(dv.LOST_DAY)).when(rnum % 10 == 1, F.lit(None)).otherwise(F.col("RENT_DT")))
    lake.land_fact(day.withColumn("_request_day", F.lit(dv.PERIOD[0])), base, FACT_SERVICE,
                   date_col="_request_day", keep_day=False)
    t = ods.ods_fact_table(scratch_path(spark, "land_by_request_day_ods"))
    ods.load_ods(spark, lake.read_landed(spark, base, FACT_SERVICE, FACT_API_ROW), t)
    return tb.read_table(spark, t)


@register("lower_names")
def lower_names(spark, sf_dir):
    base = _landed_lake(spark, sf_dir, "lower_names")
    return lake.lower_names(lake.read_landed(spark, base, FACT_SERVICE, FACT_API_ROW))


@register("land_snapshot_readback")
def land_snapshot_readback(spark, sf_dir):
    base = scratch_path(spark, "land_snapshot_readback")
    api = dv.station_api_rows(spark, sf_dir)
    lake.land_snapshot(api.where(F.col("stationId").endswith("7")), base, DIM_SERVICE, "2024-01-31")
    lake.land_snapshot(api, base, DIM_SERVICE, SNAPSHOT_DAY)
    return lake.read_snapshot(spark, base, DIM_SERVICE, STATION_API_ROW, SNAPSHOT_DAY)


@register("ods_reload")
def ods_reload(spark, sf_dir):
    """A9 -> A10 -> A12: landed fact into the ODS text table, read back."""
    base = _landed_lake(spark, sf_dir, "ods_reload_lake")
    t = ods.ods_fact_table(scratch_path(spark, "ods_reload_ods"))
    ods.load_ods(spark, lake.read_landed(spark, base, FACT_SERVICE, FACT_API_ROW), t)
    ods.load_ods(spark, lake.read_landed(spark, base, FACT_SERVICE, FACT_API_ROW), t)
    return tb.read_table(spark, t)


@register("ods_empty_guard")
def ods_empty_guard(spark, sf_dir):
    """A snapshot day with no data leaves the previous station ODS in place."""
    base = scratch_path(spark, "ods_empty_guard_lake")
    lake.land_snapshot(dv.station_api_rows(spark, sf_dir), base, DIM_SERVICE, SNAPSHOT_DAY)
    t = ods.ods_station_table(scratch_path(spark, "ods_empty_guard_ods"))
    first = ods.load_ods_guarded(spark, lake.read_snapshot(spark, base, DIM_SERVICE, STATION_API_ROW, SNAPSHOT_DAY), t)
    empty = lake.read_snapshot(spark, base, DIM_SERVICE, STATION_API_ROW, EMPTY_SNAPSHOT_DAY)
    second = ods.load_ods_guarded(spark, empty, t)
    assert first.loaded and not second.loaded, (first, second)
    return tb.read_table(spark, t)


@register("preview_shape")
def preview_shape(spark, sf_dir):
    return ods.shape(dv.table(spark, sf_dir, "lineitem"))


@register("preview_rows")
def preview_rows(spark, sf_dir):
    """The first five lineitem rows, ordered by every column so ties cannot
    make the preview differ between runs."""
    li = dv.table(spark, sf_dir, "lineitem")
    return ods.preview(li, 5, li.columns)


def _orders_pages(spark, sf_dir, rent_dt=dv.PAGES_DAY):
    return dv.landed_orders_pages(spark, sf_dir, rent_dt=rent_dt)


@register("pages_unpack_fact")
def pages_unpack_fact(spark, sf_dir):
    return pages.unpack_pages_fact(_orders_pages(spark, sf_dir), dv.orders_row_schema(spark, sf_dir))


@register("pages_unpack_fact_stop")
def pages_unpack_fact_stop(spark, sf_dir):
    """Page 8 answered RESULT: only pages 1-7 are read."""
    p = dv.with_result_page(_orders_pages(spark, sf_dir), 8)
    return pages.unpack_pages_fact(p, dv.orders_row_schema(spark, sf_dir))


@register("pages_unpack_dim")
def pages_unpack_dim(spark, sf_dir):
    return pages.unpack_pages_dim(_orders_pages(spark, sf_dir, None), dv.orders_row_schema(spark, sf_dir))


@register("page_ranges")
def page_ranges(spark, sf_dir):
    """A3 over the daily totals of ``orders`` by order date."""
    o = dv.table(spark, sf_dir, "orders")
    totals = o.groupBy(F.date_format("o_orderdate", "yyyyMMdd").alias("rent_dt")).agg(
        F.count(F.lit(1)).alias("list_total_count"))
    return pages.page_ranges(totals)


@register("page_audit")
def page_audit(spark, sf_dir):
    """D7 over a complete day and a day cut short by a RESULT page."""
    good = _orders_pages(spark, sf_dir, "20240101")
    cut = dv.with_result_page(_orders_pages(spark, sf_dir, "20240102"), 8)
    return pages.page_audit(good.unionByName(cut), dv.orders_row_schema(spark, sf_dir))


# ---- A4, D1-D6: spine and profiles -------------------------------------------------

@register("date_spine")
def date_spine(spark, sf_dir):
    ev = dv.table(spark, sf_dir, "events")
    bounds = ev.agg(F.min("ts").alias("start_dt"), F.max("ts").alias("end_dt"))
    return lake.date_spine_of(bounds)


@register("rows_per_day")
def rows_per_day(spark, sf_dir):
    return dq.rows_per_day(dv.ods_fact_without_day(spark, sf_dir))


@register("schema_list")
def schema_list(spark, sf_dir):
    return dq.schema_list(spark, dv.table(spark, sf_dir, "lineitem"))


@register("null_counts")
def null_counts(spark, sf_dir):
    return dq.null_counts(dv.table(spark, sf_dir, "lineitem"))


@register("describe")
def describe(spark, sf_dir):
    return dq.describe(dv.table(spark, sf_dir, "lineitem"))


@register("describe_text")
def describe_text(spark, sf_dir):
    """D4 over the ODS fact text columns, as the landed data is profiled."""
    return dq.describe_text(dv.ods_fact(spark, sf_dir))


@register("constraint_audit")
def constraint_audit(spark, sf_dir):
    """D5 over a table without declared constraints into which every day was inserted
    twice by mistake (C3 twice)."""
    dw = tb.ParquetTable(scratch_path(spark, "constraint_audit"), DW_FACT, ("rent_dt",))
    rows = fact_ops.fact_dw_rows(dv.ods_fact(spark, sf_dir), *dv.ALL_DATES, load_ts=dv.LOAD_TS)
    tb.append_rows(spark, dw, rows)
    tb.append_rows(spark, dw, rows)
    return dq.constraint_audit(tb.read_table(spark, dw))


@register("layout_profile")
def layout_profile(spark, sf_dir):
    """D6 over a landing written in bounded batches of 100 rows per file (A6): rows of each day's
    folder, and that it has as many files as that needs at least and none above the limit."""
    base = scratch_path(spark, "layout_profile")
    lake.land_fact(dv.fact_api_rows(spark, sf_dir), base, FACT_SERVICE, rows_per_file=100)
    found = dq.layout_profile(spark, f"{base}/{FACT_SERVICE}", rows_per_file=100)
    enough = F.col("n_files") >= F.ceil(F.col("n_rows") / 100)
    return found.select(F.regexp_extract("folder", r"(year=.*)$", 1).alias("folder"), "n_rows", "n_above", enough.alias("enough_files"))


# ---- B15: the same DW statement as parameterised SQL -------------------------------


@register("fact_dw_daily_sql")
def fact_dw_daily_sql(spark, sf_dir):
    dv.ods_fact(spark, sf_dir).createOrReplaceTempView("ods_rent_daily")
    return sql_templates.fact_dw_sql(spark, "ods_rent_daily", *dv.PERIOD)


# ---- streaming: incremental DW refresh over the landed lake --------------------------


@register("stream_dw_refresh")
def stream_dw_refresh(spark, sf_dir):
    """Land all days, stream them into the DW; re-land the period (one day lost
    its rows, so its old folder stays, as landing never deletes) and stream again:
    only the re-landed days are reloaded."""
    base = _landed_lake(spark, sf_dir, "stream_dw_refresh_lake")
    dw = fl.dw_fact_table(scratch_path(spark, "stream_dw_refresh_dw"))
    ckpt = scratch_path(spark, "stream_dw_refresh_ckpt")
    for relanding in (False, True):
        if relanding:
            lost = dv.ods_fact_without_day(spark, sf_dir).where(F.col("rent_dt").between(*dv.PERIOD))
            lake.land_fact(lost.select(*[F.col(c).alias(c.upper()) for c in lost.columns]), base, FACT_SERVICE)
        q = landed_days.start_dw_refresh(spark, base, FACT_SERVICE, FACT_API_ROW, dw, ckpt, load_ts=dv.LOAD_TS)
        q.awaitTermination()
    return tb.read_table(spark, dw).select(*OUT_FACT)


def _late_rows(spark, sf_dir):
    """The API rows with the day that they were asked for: every tenth came a day late."""
    late = F.when(F.col("RNUM").cast("long") % 10 == 0, F.date_add(F.col("RENT_DT").cast("date"), 1)).otherwise(F.col("RENT_DT").cast("date"))
    return dv.fact_api_rows(spark, sf_dir).withColumn("_request_day", late.cast("string"))


@register("stream_dw_late_rows")
def stream_dw_late_rows(spark, sf_dir):
    """Late rows lie in the next day's response. All are landed and streamed; then one day is
    landed again as it was (its late rows, elsewhere, stay), and the lost day without the late
    rows of the day before, which must leave the DW."""
    base = scratch_path(spark, "stream_dw_late_rows_lake")
    dw = fl.dw_fact_table(scratch_path(spark, "stream_dw_late_rows_dw"))
    ckpt = scratch_path(spark, "stream_dw_late_rows_ckpt")
    rows = _late_rows(spark, sf_dir)
    again = rows.where((F.col("_request_day") == dv.PERIOD[0])
                       | (F.col("_request_day") == dv.LOST_DAY) & (F.col("RENT_DT") == dv.LOST_DAY))
    for landed in (rows, again):
        lake.land_fact(landed, base, FACT_SERVICE, date_col="_request_day", keep_day=False)
        landed_days.start_dw_refresh(spark, base, FACT_SERVICE, FACT_API_ROW, dw, ckpt, load_ts=dv.LOAD_TS).awaitTermination()
    return tb.read_table(spark, dw).select(*OUT_FACT)


@register("fact_job_late_rows")
def fact_job_late_rows(spark, sf_dir):
    """The batch over the same landings: the ODS by request day, only changed days loaded, and the
    DW of the period from the request days that hold it."""
    base = scratch_path(spark, "fact_job_late_rows_lake")
    ods_t = ods.ods_fact_days_table(scratch_path(spark, "fact_job_late_rows_ods"))
    dw = fl.dw_fact_table(scratch_path(spark, "fact_job_late_rows_dw"))
    rows = _late_rows(spark, sf_dir)
    for landed in (rows, rows.where(F.col("_request_day") == dv.PERIOD[0])):
        lake.land_fact(landed, base, FACT_SERVICE, date_col="_request_day", keep_day=False)
        ods.load_ods_days(spark, base, FACT_SERVICE, FACT_API_ROW, ods_t)
        index = day_index.update(spark, base, FACT_SERVICE, FACT_API_ROW)
        fl.load_fact_dw(spark, ods.read_ods_days(spark, ods_t, index, *dv.PERIOD), dw, *dv.PERIOD, load_ts=dv.LOAD_TS)
    return tb.read_table(spark, dw).select(*OUT_FACT)


@register("ods_by_day")
def ods_by_day(spark, sf_dir):
    """A12 by day after landings that change some days: equal to a full refresh."""
    base = scratch_path(spark, "ods_by_day_lake")
    t = ods.ods_fact_days_table(scratch_path(spark, "ods_by_day_ods"))
    rows = _late_rows(spark, sf_dir)
    half = rows.where(F.col("RNUM").cast("long") % 2 == 0)
    for landed in (half, rows.where(F.col("_request_day") <= dv.LOST_DAY), rows):
        lake.land_fact(landed, base, FACT_SERVICE, date_col="_request_day", keep_day=False)
        ods.load_ods_days(spark, base, FACT_SERVICE, FACT_API_ROW, t)
    return ods.read_ods_days(spark, t)


@register("landing_gate")
def landing_gate(spark, sf_dir):
    """D7 at load: a complete day and one cut short by a RESULT page are landed, and the pass that
    writes them reports the truncated response; beside it, the rows that the lake has."""
    base, seen = scratch_path(spark, "landing_gate_lake"), Observation("landing_gate")
    schema = dv.orders_row_schema(spark, sf_dir)
    both = _orders_pages(spark, sf_dir, "20240101").unionByName(
        dv.with_result_page(_orders_pages(spark, sf_dir, "20240102"), 8))
    rows = pages.unpack_pages_fact(both, schema, day_as="_request_day", observation=seen)
    lake.land_fact(rows, base, dv.ORDERS_SERVICE, date_col="_request_day", keep_day=False)
    found = seen.get
    kinds = {"responses": "long", "truncated": "long", "rows_announced": "long", "rows_collected": "long",
             "first_truncated": "string"}
    return lake.read_landed(spark, base, dv.ORDERS_SERVICE, schema).agg(F.count("*").alias("rows_landed")).select(
        *[F.lit(found[c]).cast(t).alias(c) for c, t in kinds.items()], "rows_landed")


# ---- the two daily jobs end to end ----------------------------------------------------

@register("fact_end_to_end")
def fact_end_to_end(spark, sf_dir):
    """Day pages -> rows -> lake -> ODS -> DW for the test period."""
    landed = dv.land_pages(spark, dv.fact_api_pages(spark, sf_dir, FACT_SERVICE), "e2e_fact_pages")
    dw = fl.dw_fact_table(scratch_path(spark, "e2e_fact_dw"))
    fl.run_fact_job(spark, landed, FACT_API_ROW, scratch_path(spark, "e2e_fact_lake"), FACT_SERVICE,
                    ods.ods_fact_days_table(scratch_path(spark, "e2e_fact_ods")), dw, *dv.PERIOD,
                    load_ts=dv.LOAD_TS)
    return tb.read_table(spark, dw).select(*OUT_FACT)


@register("station_end_to_end")
def station_end_to_end(spark, sf_dir):
    """Station pages -> rows -> snapshot -> ODS -> upsert + soft delete of the seed dimension."""
    landed = dv.land_pages(spark, dv.station_api_pages(spark, sf_dir, DIM_SERVICE), "e2e_station_pages")
    dw = sl.dw_station_table(scratch_path(spark, "e2e_station_dw"))
    tb.overwrite_table(spark, dw, dv.dw_station_seed(spark, sf_dir))
    sl.run_station_job(spark, landed, STATION_API_ROW, scratch_path(spark, "e2e_station_lake"), DIM_SERVICE,
                       SNAPSHOT_DAY, ods.ods_station_table(scratch_path(spark, "e2e_station_ods")), dw,
                       load_ts=dv.LOAD_TS)
    return tb.read_table(spark, dw)


@register("stream_station_refresh")
def stream_station_refresh(spark, sf_dir):
    """Two daily snapshots (a partial one, then the full one) streamed into the
    seeded dimension: the day-by-day result equals one load of the last day."""
    base = scratch_path(spark, "stream_station_lake")
    api = dv.station_api_rows(spark, sf_dir)
    dw = sl.dw_station_table(scratch_path(spark, "stream_station_dw"))
    tb.overwrite_table(spark, dw, dv.dw_station_seed(spark, sf_dir))
    o = ods.ods_station_table(scratch_path(spark, "stream_station_ods"))
    ckpt = scratch_path(spark, "stream_station_ckpt")
    for day, rows in (("2024-01-31", api.where(F.col("stationId").endswith("7"))), (SNAPSHOT_DAY, api)):
        lake.land_snapshot(rows, base, DIM_SERVICE, day)
        q = snapshots.start_station_refresh(spark, base, DIM_SERVICE, STATION_API_ROW, o, dw, ckpt,
                                            load_ts=dv.LOAD_TS)
        q.awaitTermination()
    return tb.read_table(spark, dw)
