"""Rows dated on another day than the one that was asked for: the day index, the stream, the batch
over an ODS by request day, and what each of them reads and writes."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from rental_mart.operators import fact as fact_ops
from rental_mart.operators import tables as tb
from rental_mart.plans import fact_load as fl
from rental_mart.schemas import FACT_API_ROW
from rental_mart.sources import day_index, lake, ods
from rental_mart.streaming import landed_days

TS = "2024-02-01 00:00:00"
D5, D6, D10, D11 = (dt.date(2024, 1, d) for d in (5, 6, 10, 11))


def responses(spark, *rows):
    """(request day, row's date, station) -> API rows with their request day."""
    names = FACT_API_ROW.fieldNames()

    def one(i, asked, dated, station):
        v = {"RENT_DT": dated, "RENT_ID": station, "RENT_NM": f"1. {station}", "RENT_TYPE": "t", "USE_CNT": "1", "RNUM": str(i)}
        return tuple(v.get(n, 0 if n in ("START_INDEX", "END_INDEX") else "") for n in names) + (asked,)

    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in FACT_API_ROW.fields] + ["_asked string"])
    return spark.createDataFrame([one(i, *r) for i, r in enumerate(rows)], schema)


def land(spark, base, *rows):
    lake.land_fact(responses(spark, *rows), base, "svc", date_col="_asked", keep_day=False)


def stations(spark, dw):
    return sorted((str(r[0]), r[1], r[2]) for r in tb.read_table(spark, dw).select("rent_dt", "rent_id", "use_cnt").collect())


def stream(spark, base, dw):
    landed_days.start_dw_refresh(spark, base, "svc", FACT_API_ROW, dw, f"{base}/ckpt", load_ts=TS).awaitTermination()
    return stations(spark, dw)


def batch(spark, base, tag):
    """The DW of January from everything landed, through a full ODS."""
    t, dw = ods.ods_fact_table(f"{base}/full_ods_{tag}"), fl.dw_fact_table(f"{base}/full_dw_{tag}")
    ods.load_ods(spark, lake.read_landed(spark, base, "svc", FACT_API_ROW), t)
    fl.load_fact_dw(spark, tb.read_table(spark, t), dw, "2024-01-01", "2024-01-31", load_ts=TS)
    return stations(spark, dw)


def test_stream_keeps_and_drops_late_rows_as_the_batch_does(spark, tmp_base):
    dw = fl.dw_fact_table(f"{tmp_base}/dw")
    land(spark, tmp_base, ("2024-01-05", "2024-01-05", "A"), ("2024-01-10", "2024-01-05", "LATE"), ("2024-01-10", "2024-01-10", "B"))
    first = stream(spark, tmp_base, dw)
    assert first == batch(spark, tmp_base, 1) == [("2024-01-05", "A", 1), ("2024-01-05", "LATE", 1), ("2024-01-10", "B", 1)]
    land(spark, tmp_base, ("2024-01-05", "2024-01-05", "A2"))  # the day again: LATE lies elsewhere and stays
    assert stream(spark, tmp_base, dw) == batch(spark, tmp_base, 2) == [("2024-01-05", "A2", 1), ("2024-01-05", "LATE", 1), ("2024-01-10", "B", 1)]
    land(spark, tmp_base, ("2024-01-11", "2024-01-05", "LATER"), ("2024-01-11", "2024-01-06", "C"))
    assert stream(spark, tmp_base, dw) == batch(spark, tmp_base, 3)
    land(spark, tmp_base, ("2024-01-10", "2024-01-10", "B"))  # without LATE now: it must go
    after = stream(spark, tmp_base, dw)
    assert after == batch(spark, tmp_base, 4) and not any(r[1] == "LATE" for r in after) and ("2024-01-05", "LATER", 1) in after
    land(spark, tmp_base, ("2024-01-10", "20240105", "COMPACT"), ("2024-01-10", None, "NO DATE"), ("2024-01-10", "x", "BAD"))
    assert stream(spark, tmp_base, dw) == batch(spark, tmp_base, 5)
    # A batch that is run again changes nothing.
    landed_days.refresh_batch(spark, tmp_base, "svc", FACT_API_ROW, dw, ["2024-01-10", "2024-01-11"], TS)
    assert stations(spark, dw) == batch(spark, tmp_base, 6)


def test_the_index_tells_which_folders_hold_a_day(spark, tmp_base):
    land(spark, tmp_base, ("2024-01-05", "2024-01-05", "A"), ("2024-01-10", "2024-01-05", "LATE"), ("2024-01-10", "20240106", "B"), (None, "2024-01-06", "UNDATED FOLDER"))
    t = day_index.update(spark, tmp_base, "svc", FACT_API_ROW)
    pairs = lambda: sorted((str(r["request_day"]), str(r["rent_day"]), r["n_rows"]) for r in tb.read_table(spark, t).collect())
    assert pairs() == [("1900-01-01", "2024-01-06", 1), ("2024-01-05", "2024-01-05", 1), ("2024-01-10", "2024-01-05", 1), ("2024-01-10", "2024-01-06", 1)]
    assert day_index.holding(spark, t, D5, D5) == [D5, D10]
    assert day_index.holding(spark, t, D6, D6) == [day_index.NO_DAY, D10]
    read = lake.read_request_days(spark, tmp_base, "svc", FACT_API_ROW, day_index.holding(spark, t, D6, D6))
    folders = {os.path.dirname(f).split("svc/")[1] for f in read.inputFiles()}
    assert folders == {"year=2024/month=01/day=10", "/".join(f"{p}=__HIVE_DEFAULT_PARTITION__" for p in lake.DAY_PARTS)}
    before = ods_files(t.path)
    land(spark, tmp_base, ("2024-01-10", "2024-01-10", "B"))
    t = day_index.update(spark, tmp_base, "svc", FACT_API_ROW)
    assert pairs()[2:] == [("2024-01-10", "2024-01-05", 0), ("2024-01-10", "2024-01-06", 0), ("2024-01-10", "2024-01-10", 1)]
    assert day_index.holding(spark, t, D5, D5) == [D5]
    assert day_index.rent_days_of(spark, t, [D10]) == [D5, D6, D10]
    after = ods_files(t.path)
    assert all("request_day=2024-01-10" in f for f, _ in set(before.items()) ^ set(after.items()))
    assert day_index.update(spark, tmp_base, "svc", FACT_API_ROW) == t and ods_files(t.path) == after


def ods_rows(spark, df):
    return sorted(tuple(r) for r in df.fillna("NULL").collect())


def ods_files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_ods_by_day_rewrites_changed_days_only(spark, tmp_base, monkeypatch):
    t = ods.ods_fact_days_table(f"{tmp_base}/ods_days")
    load = lambda: ods.load_ods_days(spark, tmp_base, "svc", FACT_API_ROW, t)
    full = lambda: lake.lower_names(lake.read_landed(spark, tmp_base, "svc", FACT_API_ROW))
    assert load() == [] and ods.read_ods_days(spark, t).count() == 0  # nothing landed yet
    land(spark, tmp_base, ("2024-01-05", "2024-01-05", "A"), ("2024-01-10", "2024-01-05", "LATE"), ("2024-01-11", None, "B"), (None, "2024-01-05", "U"))
    assert load() == [day_index.NO_DAY, D5, D10, D11]
    assert ods_rows(spark, ods.read_ods_days(spark, t)) == ods_rows(spark, full())
    before = ods_files(t.path)
    assert load() == [] and ods_files(t.path) == before
    land(spark, tmp_base, ("2024-01-10", "2024-01-10", "B"))
    assert load() == [D10]
    changed = set(before.items()) ^ set(ods_files(t.path).items())
    assert changed and all("request_day=2024-01-10" in f for f, _ in changed)
    assert ods_rows(spark, ods.read_ods_days(spark, t)) == ods_rows(spark, full())

    # A load that fails before it is recorded is done again.
    land(spark, tmp_base, ("2024-01-11", "2024-01-11", "C"))
    with monkeypatch.context() as m:
        m.setattr(day_index, "fingerprints", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            load()
    assert load() == [D11]
    assert ods_rows(spark, ods.read_ods_days(spark, t)) == ods_rows(spark, full())


def test_the_period_is_read_from_the_days_that_hold_it(spark, tmp_base):
    land(spark, tmp_base, ("2024-01-05", "2024-01-05", "A"), ("2024-01-10", "20240105", "LATE"), ("2024-01-11", "2024-01-11", "C"))
    t = ods.ods_fact_days_table(f"{tmp_base}/ods_days")
    ods.load_ods_days(spark, tmp_base, "svc", FACT_API_ROW, t)
    index = day_index.update(spark, tmp_base, "svc", FACT_API_ROW)
    rows = ods.read_ods_days(spark, t, index, "2024-01-05", "2024-01-05")
    for variant in ("iso", "any"):
        dw = fact_ops.fact_dw_rows(rows, "2024-01-05", "2024-01-05", variant=variant, load_ts=TS)
        plan = dw._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and "request_day" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
        assert sorted(r["rent_id"] for r in dw.collect()) == (["A"] if variant == "iso" else ["A", "LATE"])
    assert {f.split("request_day=")[1][:10] for f in rows.inputFiles()} >= {"2024-01-05", "2024-01-10"}


def test_keys_are_checked_in_the_touched_days_only(spark, tmp_base, monkeypatch):
    dw = fl.dw_fact_table(f"{tmp_base}/dw")
    land(spark, tmp_base, *((f"2024-01-{d:02d}", f"2024-01-{d:02d}", "A") for d in (5, 6, 10)))
    rows = lake.lower_names(lake.read_landed(spark, tmp_base, "svc", FACT_API_ROW))
    make = lambda s, e: fact_ops.fact_dw_rows(rows, s, e, load_ts=TS)
    tb.append_rows(spark, dw, make("2024-01-05", "2024-01-06"))
    seen = []
    own = tb._rows_of_days
    monkeypatch.setattr(tb, "_rows_of_days", lambda *a: seen.append(own(*a)) or seen[-1])
    tb.append_rows(spark, dw, make("2024-01-10", "2024-01-10"))
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "rent_dt" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    with pytest.raises(ValueError, match="already has"):
        tb.append_rows(spark, dw, make("2024-01-06", "2024-01-10"))
    assert len(stations(spark, dw)) == 3
