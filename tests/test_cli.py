"""The command-line jobs run end to end on landed pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from rental_mart.__main__ import main
from rental_mart.sources import derived as dv

from conftest import SF001


def test_fact_and_station_jobs(spark, tmp_base):
    dv.fact_api_pages(spark, SF001).write.parquet(f"{tmp_base}/fact_pages")
    dv.station_api_pages(spark, SF001).write.parquet(f"{tmp_base}/station_pages")
    out = main(["fact", "--pages", f"{tmp_base}/fact_pages", "--lake", f"{tmp_base}/lake",
                "--ods", f"{tmp_base}/ods_fact", "--dw", f"{tmp_base}/dw_fact", "--dm", f"{tmp_base}/dm",
                "--start", "2024-01-10", "--end", "2024-01-16", "--load-ts", "2024-02-01 00:00:00",
                "--catalog"], spark)
    assert out["dw_rows"] > 0 and out["dm_rows"] == 7
    assert spark.sql("SELECT count(*) FROM dw.fact_rent_daily").first()[0] == out["dw_rows"]
    assert spark.sql("SELECT count(DISTINCT rent_dt) FROM dm.fact_rent_daily").first()[0] == 7
    for t in ("ods.fact_rent_daily", "dw.fact_rent_daily", "dm.fact_rent_daily"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    out = main(["station", "--pages", f"{tmp_base}/station_pages", "--lake", f"{tmp_base}/lake",
                "--ods", f"{tmp_base}/ods_station", "--dw", f"{tmp_base}/dw_station",
                "--snapshot-dt", "2024-02-01"], spark)
    assert out["active_stations"] == dv.table(spark, SF001, "supplier").count()


def test_fact_job_lands_only_the_period(spark, tmp_base):
    from rental_mart.plans import fact_load as fl
    from rental_mart.schemas import FACT_API_ROW
    from rental_mart.sources import lake, ods

    pages = dv.fact_api_pages(spark, SF001)
    dw = fl.dw_fact_table(f"{tmp_base}/dw")
    fl.run_fact_job(spark, pages, FACT_API_ROW, f"{tmp_base}/lake", "svc", ods.ods_fact_table(f"{tmp_base}/ods"),
                    dw, "2024-01-10", "2024-01-12", load_ts="2024-02-01 00:00:00")
    landed_days = {r[0] for r in lake.read_landed(spark, f"{tmp_base}/lake", "svc", FACT_API_ROW)
                   .select("RENT_DT").distinct().collect()}
    assert landed_days == {"2024-01-10", "2024-01-11", "2024-01-12"}


def test_fact_job_keeps_every_landed_day(spark, tmp_base):
    """A late row and one without a date stay with the day asked for; the ODS holds all landed days."""
    from rental_mart.operators import tables as tb
    from rental_mart.plans import fact_load as fl
    from rental_mart.schemas import FACT_API_ROW
    from rental_mart.sources import ods

    rows = dv.fact_api_rows(spark, SF001).where("RENT_DT between '2024-01-05' and '2024-01-06'")
    day = F.replace(F.col("RENT_DT"), F.lit("-"), F.lit(""))
    moved = F.when(F.col("RNUM").cast("long") % 5 == 0, F.lit("2024-01-05")).when(
        F.col("RNUM").cast("long") % 5 == 1, F.lit(None)).otherwise(F.col("RENT_DT"))
    named = rows.withColumn("_d", day).withColumn("RENT_DT", moved)
    pages = dv.pack_pages(spark, named, F.col("RNUM").cast("long"), "svc", F.col("_d"))
    o, dw = ods.ods_fact_table(f"{tmp_base}/ods"), fl.dw_fact_table(f"{tmp_base}/dw")
    for d in ("2024-01-05", "2024-01-06"):
        fl.run_fact_job(spark, pages, FACT_API_ROW, f"{tmp_base}/lake", "svc", o, dw, d, d, load_ts="2024-02-01 00:00:00")
    assert tb.read_table(spark, o).count() == rows.count()
    assert tb.read_table(spark, o).where("rent_dt is null").count() == named.where("RENT_DT is null").count() > 0
