"""Plan tests: pushdown, pruning, shuffle count, no Python evaluation."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from rental_mart.plans.keys import QUERIES
from rental_mart.operators import fact as fact_ops
from rental_mart.operators import station as st
from rental_mart.operators import tables as tb
from rental_mart.schemas import FACT_API_ROW
from rental_mart.sources import derived as dv
from rental_mart.sources import lake, ods

from conftest import SF001

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
            "PythonMapInArrow", "FlatMapCoGroupsInPandas", "AggregateInPandas", "WindowInPandas")


def plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.fixture(scope="module")
def ods_table(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("lake"))
    lake.land_fact(dv.fact_api_rows(spark, SF001), base, "svc")
    t = ods.ods_fact_table(f"{base}/ods_fact")
    ods.load_ods(spark, lake.read_landed(spark, base, "svc", FACT_API_ROW), t)
    return base, t


def test_b1_filter_and_columns_reach_the_scan(spark, ods_table):
    _, t = ods_table
    df = fact_ops.aggregate_fact(fact_ops.clean_fact_iso(tb.read_table(spark, t), *dv.PERIOD))
    p = plan(df)
    assert "GreaterThanOrEqual(rent_dt,2024-01-10)" in p and "LessThanOrEqual(rent_dt,2024-01-16)" in p
    read_schema = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    assert "rnum" not in read_schema and "start_index" not in read_schema
    assert len(re.findall(r"Arguments: hashpartitioning", p)) == 1


def test_period_read_prunes_day_folders(spark, ods_table):
    base, _ = ods_table
    df = lake.read_landed(spark, base, "svc", FACT_API_ROW, *dv.PERIOD)
    read = {r[0] for r in df.select(F.input_file_name()).distinct().collect()}
    assert len(read) == 7 and all(re.search(r"year=2024/month=01/day=1[0-6]", f) for f in read)
    assert re.search(r"PartitionFilters: \[.*concat\(year", plan(df))


def test_soft_delete_avoids_nested_loop_and_null_aware_join(spark):
    src = st.clean_station(dv.ods_station(spark, SF001))
    p = plan(st.soft_delete_missing(dv.dw_station_seed(spark, SF001), src, dv.LOAD_TS))
    assert "NestedLoopJoin" not in p and "isNullAwareAntiJoin: true" not in p
    assert "CartesianProduct" not in p


def test_no_python_evaluation_in_any_registered_query(spark):
    for key, fn in QUERIES.items():
        p = plan(fn(spark, SF001))
        for node in PY_NODES:
            assert node not in p, f"{key} evaluates Python ({node})"
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, key


def test_parameterised_scan_is_pushed(spark, ods_table):
    from rental_mart.plans import sql_templates

    _, t = ods_table
    tb.register_view(spark, "ods_for_sql", t)
    p = plan(sql_templates.period_scan(spark, "ods_for_sql", *dv.PERIOD))
    assert "GreaterThanOrEqual(rent_dt,2024-01-10)" in p


def test_insert_by_name_into_catalog_table(spark, tmp_path):
    from rental_mart.plans import sql_templates

    spark.sql(f"CREATE TABLE dw_sql_t (a INT, b STRING) USING parquet LOCATION '{tmp_path}/t'")
    try:
        sql_templates.insert_by_name(spark, "dw_sql_t", spark.createDataFrame([("x", 1)], "b string, a int"))
        assert [tuple(r) for r in spark.table("dw_sql_t").collect()] == [(1, "x")]
    finally:
        spark.sql("DROP TABLE IF EXISTS dw_sql_t")


def test_dm_refresh_reads_only_period_partitions(spark, tmp_path):
    from rental_mart.operators import mart
    from rental_mart.plans import fact_load as fl

    dw = fl.dw_fact_table(f"{tmp_path}/dw")
    fl.load_fact_dw(spark, dv.ods_fact(spark, SF001), dw, *dv.WIDE_PERIOD, load_ts=dv.LOAD_TS)
    src = tb.read_period(spark, dw, "2024-01-10", "2024-01-16")
    p = plan(mart.daily_totals(src))
    assert re.search(r"PartitionFilters: \[isnotnull\(rent_dt", p)
    listed = src.inputFiles()
    assert listed and all(re.search(r"rent_dt=2024-01-1[0-6]", f) for f in listed)
    assert src.count() == tb.read_table(spark, dw).where(
        F.col("rent_dt").between(F.lit("2024-01-10").cast("date"), F.lit("2024-01-16").cast("date"))).count()


def test_partial_aggregation_precedes_the_exchange(spark, ods_table):
    """Hot keys are combined map-side: the DW aggregate and the page-bound
    aggregate run partial aggregates before their only exchange."""
    from rental_mart.schemas import LANDED_PAGE
    from rental_mart.sources import pages as pg

    _, t = ods_table
    p = plan(fact_ops.aggregate_fact(fact_ops.clean_fact_iso(tb.read_table(spark, t), *dv.PERIOD)), "simple")
    assert p.index("Exchange hashpartitioning") < p.index("partial_max(rent_nm")
    pages = spark.createDataFrame([], LANDED_PAGE)
    p = plan(pg.unpack_pages_fact(pages, FACT_API_ROW), "simple")
    assert "partial_min(CASE WHEN NOT ok" in p


def test_station_load_reads_the_source_once(spark, tmp_path):
    """The join, the inserts beside it and the NOT IN flags share one aggregate of the source."""
    from rental_mart.plans import station_load as sl

    dv.ods_station(spark, SF001).write.parquet(f"{tmp_path}/ods")
    dv.dw_station_seed(spark, SF001).write.parquet(f"{tmp_path}/dw")
    ods_rows, dw = spark.read.parquet(f"{tmp_path}/ods"), spark.read.parquet(f"{tmp_path}/dw")
    df = sl.station_rows(dw, ods_rows, dv.LOAD_TS)
    df.collect()
    run, below = [], None            # the plan as it was run: adaptive plans also print what they began with
    for line in plan(df, "simple").splitlines():
        depth = len(line) - len(line.lstrip(" :"))
        if below is not None and depth <= below:
            below = None
        if below is None and "== Initial Plan ==" in line:
            below = depth
        if below is None:
            run.append(line)
    assert sum("FileScan" in x and "stationname" in x for x in run) == 1
    assert sum("ReusedExchange" in x for x in run) >= 2
    assert not any("NestedLoopJoin" in x or "CartesianProduct" in x for x in run)


def test_bodies_are_never_dealt_by_day_alone(spark):
    """Without broadcasts, pages with their bodies go by (service, day, range of pages)."""
    from rental_mart.schemas import LANDED_PAGE
    from rental_mart.sources import pages as pg

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(pg.unpack_pages_fact(spark.createDataFrame([("s", "d", 1, 1000, "x")], LANDED_PAGE), FACT_API_ROW), "formatted")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\n]*)\]\nArguments: ([^\n]*)", p)
    with_body = [keys for columns, keys in exchanges if "body#" in columns]
    assert with_body and all("page_range" in keys for keys in with_body)


def test_packed_rows_are_never_dealt_by_day_alone(spark):
    """Without broadcasts, the rows put into pages go by (day, range) and then by page."""
    rows = spark.range(10).selectExpr("id", "'d' AS day")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(dv.pack_pages(spark, rows, "id", "svc", F.col("day")), "formatted")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\n]*)\]\nArguments: ([^\n]*)", p)
    with_rows = [keys for columns, keys in exchanges if "_order#" in columns or "id#" in columns or "buf#" in columns]
    assert len(with_rows) == 2 and all("_range#" in keys or "page_no#" in keys for keys in with_rows)
