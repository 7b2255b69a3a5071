"""State tests: period refresh and the station dimension."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rental_mart.operators import station as st
from rental_mart.operators import tables as tb
from rental_mart.plans import fact_load as fl
from rental_mart.plans import station_load as sl
from rental_mart.schemas import DW_STATION, ODS_STATION
from rental_mart.sources import derived as dv

from conftest import SF001

OUT = ["rent_dt", "rent_id", "rent_type", "gender_cd", "age_type", "use_cnt", "exer_amt", "move_time"]


def rows(df):
    return sorted(tuple(r) for r in df.select(*OUT).collect())


def test_refresh_twice_equals_once(spark, tmp_base):
    ods = dv.ods_fact(spark, SF001)
    a = fl.dw_fact_table(f"{tmp_base}/a")
    b = fl.dw_fact_table(f"{tmp_base}/b")
    fl.load_fact_dw(spark, ods, a, *dv.PERIOD, load_ts=dv.LOAD_TS)
    fl.load_fact_dw(spark, ods, b, *dv.PERIOD, load_ts=dv.LOAD_TS)
    fl.load_fact_dw(spark, ods, b, *dv.PERIOD, load_ts=dv.LOAD_TS)
    assert rows(tb.read_table(spark, a)) == rows(tb.read_table(spark, b))


def test_lost_day_becomes_empty_and_outside_rows_stay(spark, tmp_base):
    t = fl.dw_fact_table(f"{tmp_base}/dw")
    fl.load_fact_dw(spark, dv.ods_fact(spark, SF001), t, *dv.WIDE_PERIOD, load_ts=dv.LOAD_TS)
    before = tb.read_table(spark, t)
    outside = rows(before.where(~F.col("rent_dt").between(dt.date(2024, 1, 10), dt.date(2024, 1, 16))))
    fl.load_fact_dw(spark, dv.ods_fact_without_day(spark, SF001), t, *dv.PERIOD, load_ts=dv.LOAD_TS)
    after = tb.read_table(spark, t)
    assert after.where(F.col("rent_dt") == dt.date(2024, 1, 12)).count() == 0
    assert after.where(F.col("rent_dt") == dt.date(2024, 1, 11)).count() > 0
    assert rows(after.where(~F.col("rent_dt").between(dt.date(2024, 1, 10), dt.date(2024, 1, 16)))) == outside


def test_delete_period_keeps_null_dates(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (None,), (dt.date(2024, 2, 1),)], "rent_dt date")
    kept = [r.rent_dt for r in tb.delete_period(df, "2024-01-01", "2024-01-31").collect()]
    assert sorted(kept, key=str) == sorted([None, dt.date(2024, 2, 1)], key=str)


def test_failed_write_leaves_table(spark, tmp_base):
    t = fl.dw_fact_table(f"{tmp_base}/dw")
    fl.load_fact_dw(spark, dv.ods_fact(spark, SF001), t, *dv.PERIOD, load_ts=dv.LOAD_TS)
    n = tb.read_table(spark, t).count()
    bad = dv.ods_fact(spark, SF001).withColumn("use_cnt", F.lit("N/A"))
    with pytest.raises(Exception):
        fl.load_fact_dw(spark, bad, t, *dv.PERIOD, load_ts=dv.LOAD_TS)
    assert tb.read_table(spark, t).count() == n


def test_append_by_name_rejects_unknown_columns(spark, tmp_base):
    t = fl.dw_fact_table(f"{tmp_base}/dw")
    with pytest.raises(ValueError):
        tb.append_rows(spark, t, spark.createDataFrame([(1,)], "nope int"))


def test_append_refuses_broken_constraints(spark, tmp_base):
    t = fl.dw_fact_table(f"{tmp_base}/dw")
    ods = dv.ods_fact(spark, SF001)
    fl.load_fact_dw(spark, ods, t, "2024-01-01", "2024-01-02", load_ts=dv.LOAD_TS)
    n = tb.read_table(spark, t).count()
    good = fl.fact_ops.fact_dw_rows(ods, "2024-01-03", "2024-01-03", load_ts=dv.LOAD_TS)
    old = fl.fact_ops.fact_dw_rows(ods, "2024-01-02", "2024-01-02", load_ts=dv.LOAD_TS)
    for bad in (old, good.unionByName(good), good.withColumn("rent_id", F.lit(None).cast("string")),
                good.withColumn("rent_id", F.lit("x" * 60))):
        with pytest.raises(Exception):
            tb.append_rows(spark, t, bad)
        assert tb.read_table(spark, t).count() == n
    tb.append_rows(spark, t, good)
    assert tb.read_table(spark, t).count() == n + good.count()


def test_refresh_that_dies_anywhere_is_old_or_new(spark, tmp_base, monkeypatch):
    wide = fl.fact_ops.fact_dw_rows(dv.ods_fact(spark, SF001), "2024-01-10", "2024-01-12", load_ts=dv.LOAD_TS)
    new = fl.fact_ops.fact_dw_rows(dv.ods_fact_without_day(spark, SF001), "2024-01-10", "2024-01-12",
                                   load_ts=dv.LOAD_TS).withColumn("use_cnt", F.lit(7).cast("long"))
    old_rows, new_rows = rows(wide), rows(new)
    assert old_rows != new_rows
    real = {f: getattr(tb, f) for f in ("_rename", "_delete", "_mkdirs")}
    seen, k = set(), 0
    while True:
        t = fl.dw_fact_table(f"{tmp_base}/dw{k}")
        tb.refresh_period(spark, t, wide, "2024-01-10", "2024-01-12")
        calls = [0]

        def dying(f):
            def call(*a):
                calls[0] += 1
                if calls[0] == k + 1:
                    raise OSError("driver died")
                return real[f](*a)
            return call

        for f in real:
            monkeypatch.setattr(tb, f, dying(f))
        try:
            tb.refresh_period(spark, t, new, "2024-01-10", "2024-01-12")
            finished = True
        except OSError:
            finished = False
        monkeypatch.undo()
        tb.recover(spark, t)
        got = rows(tb.read_table(spark, t))
        assert got in (old_rows, new_rows), k
        seen.add(got == new_rows)
        assert not [n for n, _ in tb._children(spark, t.path) if n.startswith(("_staging", "_ready"))]
        if finished:
            break
        k += 1
    assert seen == {True, False} and k > 3


# ---- station dimension ---------------------------------------------------------------

TS0 = dt.datetime(2024, 1, 1)
TS1 = "2024-02-01 00:00:00"


def target(spark, rows):
    full = []
    for cd, deleted in rows:
        full.append((cd, None, "old", None, None, None, None, None, TS0, TS0, deleted))
    return spark.createDataFrame(full, DW_STATION)


def source(spark, codes):
    return st.clean_station(spark.createDataFrame(
        [("1", f"{i}. new{i}", "2", "3", "37.5", "127.1", cd) for i, cd in enumerate(codes)], ODS_STATION))


def state(df):
    return {r.station_cd: (r.station_nm, r.is_deleted, r.created_at, r.last_updated) for r in df.collect()}


def test_upsert_update_insert_revive(spark):
    t = target(spark, [("A", False), ("B", True), ("C", False)])
    out = state(st.upsert_station(t, source(spark, ["A", "B", "D"]), TS1))
    new = dt.datetime(2024, 2, 1)
    assert out["A"] == ("new0", False, TS0, new)
    assert out["B"] == ("new1", False, TS0, new)          # revived, created_at kept
    assert out["C"] == ("old", False, TS0, TS0)           # untouched
    assert out["D"] == ("new2", False, new, new)          # inserted


def test_upsert_duplicate_matching_source_key_raises(spark):
    t = target(spark, [("A", False)])
    out = st.upsert_station(t, source(spark, ["A", "A"]), TS1)
    with pytest.raises(Exception, match="target row twice.*: A"):
        out.collect()


@pytest.mark.parametrize("codes", [["A", "B", "D"], ["A", None, "D"], ["Z", "Z", "A"], [None, None], []])
def test_load_in_one_join_equals_upsert_then_soft_delete(spark, codes):
    t = target(spark, [("A", False), ("B", True), ("C", False), ("E", None), (None, False), (None, True)])
    src = source(spark, codes)
    one = st.merge_station(t, src, TS1, delete_missing=True)
    two = st.soft_delete_missing(st.upsert_station(t, src, TS1), src, TS1)
    # rows that were just inserted with a NULL code are not deleted either way
    assert sorted(map(repr, one.collect())) == sorted(map(repr, two.select(*one.columns).collect()))


def test_upsert_duplicate_new_keys_are_inserted(spark):
    t = target(spark, [("A", False)])
    out = st.upsert_station(t, source(spark, ["Z", "Z"]), TS1)
    assert out.where("station_cd = 'Z'").count() == 2


def test_soft_delete_semantics(spark):
    t = target(spark, [("A", False), ("B", True), ("C", False), (None, False)])
    new = dt.datetime(2024, 2, 1)
    out = state(st.soft_delete_missing(t, source(spark, ["A"]), TS1))
    assert out["C"] == ("old", True, TS0, new)
    assert out["B"] == ("old", True, TS0, TS0)            # already deleted: untouched
    assert out["A"] == ("old", False, TS0, TS0)
    assert out[None] == ("old", False, TS0, TS0)          # NULL NOT IN (...) is NULL


def test_soft_delete_null_source_key_disables(spark):
    t = target(spark, [("A", False), ("C", False)])
    out = state(st.soft_delete_missing(t, source(spark, ["A", None]), TS1))
    assert out["C"][1] is False


def test_soft_delete_empty_source_deletes_all_active(spark):
    t = target(spark, [("A", False), (None, False), ("B", None)])
    out = state(st.soft_delete_missing(t, source(spark, []), TS1))
    assert out["A"][1] is True and out[None][1] is True
    assert out["B"][1] is None                            # NULL flag is not "active"


def test_station_load_lifecycle(spark, tmp_base):
    dw = sl.dw_station_table(f"{tmp_base}/station")
    ods1 = spark.createDataFrame([("1", "1. a", "1", "1", "37.5", "127.1", "A"),
                                  ("1", "2. b", "1", "1", "37.5", "127.1", "B")], ODS_STATION)
    ods2 = spark.createDataFrame([("1", "1. a2", "1", "1", "37.5", "127.1", "A")], ODS_STATION)
    assert sl.load_station_dw(spark, ods1, dw, "2024-01-01 00:00:00").first().n_active == 2
    assert sl.load_station_dw(spark, ods2, dw, "2024-01-02 00:00:00").first().n_active == 1
    assert sl.load_station_dw(spark, ods1, dw, "2024-01-03 00:00:00").first().n_active == 2
    s = state(tb.read_table(spark, dw))
    assert s["B"] == ("b", False, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3))
    assert s["A"] == ("a", False, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3))


def test_recover_after_interrupted_swap(spark, tmp_base):
    dw = sl.dw_station_table(f"{tmp_base}/dim/station")
    tb.overwrite_table(spark, dw, target(spark, [("A", False), ("B", False)]))
    # a driver died between "park the old table" and "move the new one in"
    tb._rename(spark, dw.path, f"{tmp_base}/dim/_station.old-dead")
    tb._write(target(spark, [("Z", False)]), dw, f"{tmp_base}/dim/_station.staging-dead", "overwrite")
    tb.recover(spark, dw)   # what the next writer does first
    assert sorted(r.station_cd for r in tb.read_table(spark, dw).collect()) == ["A", "B"]
    assert [n for n, _ in tb._children(spark, f"{tmp_base}/dim") if n.startswith("_")] == []
    # a period refresh that died before moving its staging in leaves no trace
    t = fl.dw_fact_table(f"{tmp_base}/dw")
    fl.load_fact_dw(spark, dv.ods_fact(spark, SF001), t, *dv.PERIOD, load_ts=dv.LOAD_TS)
    tb._write(dv.ods_fact(spark, SF001).limit(0).select("rent_dt"), t, f"{t.path}/_staging-dead", "overwrite")
    fl.load_fact_dw(spark, dv.ods_fact(spark, SF001), t, *dv.PERIOD, load_ts=dv.LOAD_TS)
    assert not any(n.startswith("_staging") for n, _ in tb._children(spark, t.path))


def test_catalog_tables_follow_refreshes(spark, tmp_base):
    t = fl.dw_fact_table(f"{tmp_base}/dw_named", name="dw_t.fact_rent_daily")
    s = sl.dw_station_table(f"{tmp_base}/st_named", name="dw_t.station")
    try:
        fl.load_fact_dw(spark, dv.ods_fact(spark, SF001), t, *dv.WIDE_PERIOD, load_ts=dv.LOAD_TS)
        assert spark.sql("SELECT count(*) FROM dw_t.fact_rent_daily").first()[0] == tb.read_table(spark, t).count()
        fl.load_fact_dw(spark, dv.ods_fact_without_day(spark, SF001), t, *dv.PERIOD, load_ts=dv.LOAD_TS)
        parts = {r[0] for r in spark.sql("SHOW PARTITIONS dw_t.fact_rent_daily").collect()}
        assert "rent_dt=2024-01-12" not in parts and "rent_dt=2024-01-11" in parts
        assert spark.sql("SELECT count(*) FROM dw_t.fact_rent_daily").first()[0] == tb.read_table(spark, t).count()

        ods1 = spark.createDataFrame([("1", "1. a", "1", "1", "37.5", "127.1", "A"),
                                      ("1", "2. b", "1", "1", "37.5", "127.1", "B")], ODS_STATION)
        sl.load_station_dw(spark, ods1, s, "2024-01-01 00:00:00")
        sl.load_station_dw(spark, ods1.limit(1), s, "2024-01-02 00:00:00")
        assert spark.sql("SELECT count(*) FROM dw_t.station WHERE NOT is_deleted").first()[0] == 1
    finally:
        tb.drop_table(spark, t)
        tb.drop_table(spark, s)
        spark.sql("DROP SCHEMA IF EXISTS dw_t")
