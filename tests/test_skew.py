"""Hot keys: a third or more of the rows on one key must give exact results
through the skew-safe paths (partial aggregation, NULL / duplicate split-off,
page bounds from aggregates)."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from rental_mart.operators import fact as fact_ops
from rental_mart.operators import station as st
from rental_mart.schemas import DW_STATION, LANDED_PAGE, ODS_STATION
from rental_mart.sources import derived as dv
from rental_mart.sources import pages as pg

from conftest import SF01


def test_hot_station_day_aggregates_exactly(spark):
    ods = dv.ods_fact(spark, SF01)
    hot = (ods.withColumn("rent_dt", F.lit("2024-01-12")).withColumn("rent_id", F.lit("ST-7"))
              .withColumn("rent_nm", F.lit("107. Station 7")))
    both = ods.unionByName(hot).unionByName(hot).repartition(16)     # the hot key holds > 2/3 of rows
    clean = fact_ops.clean_fact_iso(both, "2024-01-01", "2024-01-31")
    out = fact_ops.aggregate_fact(clean)
    key = (F.col("rent_dt") == F.lit("2024-01-12").cast("date")) & (F.col("rent_id") == "ST-7")
    totals = [F.sum(m).alias(m) for m in ("use_cnt", "move_time")] + [F.count(F.lit(1)).alias("n")]
    by_groups = out.where(key).agg(*totals[:2]).first()
    by_rows = clean.where(key).agg(*totals[:2]).first()
    assert tuple(by_groups) == tuple(by_rows)
    assert out.count() == out.select("rent_dt", "rent_id", "rent_type", "gender_cd", "age_type").distinct().count()


def test_hot_unmatched_duplicate_code_is_inserted_whole(spark):
    target = spark.createDataFrame(
        [(f"ST-{i}", i, "old", None, None, 1, None, None, None, None, False) for i in range(50)], DW_STATION)
    hot = [("1", "999. hot", "1", "1", "37.5", "127.1", "HOT")] * 3000
    rest = [("1", f"{i}. s{i}", "1", "1", "37.5", "127.1", f"ST-{i}") for i in range(0, 50, 2)]
    src = st.clean_station(spark.createDataFrame(hot + rest, ODS_STATION))
    out = st.upsert_station(target, src, "2024-02-01 00:00:00")
    assert out.where("station_cd = 'HOT'").count() == 3000
    assert out.where("station_cd LIKE 'ST-%'").count() == 50
    assert out.where("station_cd = 'ST-2' AND station_nm = 's2'").count() == 1


def test_many_null_target_codes_soft_delete(spark):
    rows = [(None, None, "n", None, None, None, None, None, None, None, False)] * 2000 + \
           [("A", None, "a", None, None, None, None, None, None, None, False)]
    target = spark.createDataFrame(rows, DW_STATION)
    src = st.clean_station(spark.createDataFrame([("1", "1. b", "1", "1", "", "", "B")], ODS_STATION))
    out = st.soft_delete_missing(target, src, "2024-02-01 00:00:00")
    assert out.where("is_deleted").select("station_cd").collect()[0][0] == "A"
    assert out.where("station_cd IS NULL AND NOT is_deleted").count() == 2000


def test_one_day_with_many_pages(spark):
    rows = [{"id": str(i), "v": "x"} for i in range(1000)]
    items = [("svc", "hot", 1 + 1000 * k, 1000 * (k + 1),
              json.dumps({"svc": {"list_total_count": 60_000, "row": rows}})) for k in range(60)]
    items += [("svc", "cold", 1, 1000, json.dumps({"svc": {"list_total_count": 2, "row": rows[:2]}}))]
    landed = spark.createDataFrame(items, LANDED_PAGE).repartition(8)
    out = pg.unpack_pages_fact(landed, spark.createDataFrame([], "id string, v string").schema, keep_meta=True)
    counts = {r.rent_dt: r.n for r in out.groupBy("rent_dt").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {"hot": 60_000, "cold": 2}
