"""Scalar cleaning rules on the hand-made edge rows (FIXTURES §3)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rental_mart import functions as fx
from rental_mart.operators import fact as fact_ops
from rental_mart.schemas import ODS_FACT, ODS_STATION
from rental_mart.operators.station import clean_station


def one_col(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    return [r[0] for r in df.select(expr(F.col("c"))).collect()]


def test_rent_type(spark):
    assert one_col(spark, [" ", None, " 정기권 ", "\t"], fx.rent_type) == \
        [fx.RENT_TYPE_UNKNOWN, fx.RENT_TYPE_UNKNOWN, "정기권", "\t"]


def test_gender(spark):
    assert one_col(spark, ["f", " M ", "", None, "X"], fx.gender) == \
        [fx.GENDER_FEMALE, fx.GENDER_MALE] + [fx.GENDER_UNKNOWN] * 3


def test_age(spark):
    assert one_col(spark, ["", "기타", " 기타 ", None, " 20대 "], fx.age_type) == \
        [fx.AGE_UNKNOWN] * 4 + ["20대"]


def test_blank_int(spark):
    assert one_col(spark, ["", " 12 "], fx.blank_int) == [None, 12]


@pytest.mark.parametrize("bad", [" ", "1.5", "N/A"])
def test_blank_int_rejects(spark, bad):
    with pytest.raises(Exception):
        one_col(spark, [bad], fx.blank_int)


def test_station_name_parts(spark):
    vals = ["102. 망원역", "1. a.b", ".x", None]
    assert one_col(spark, vals, fx.station_number) == [102, 1, None, None]
    assert one_col(spark, vals, fx.station_name) == ["망원역", "a", "x", None]


def test_station_name_without_dot_fails_on_number(spark):
    with pytest.raises(Exception):
        one_col(spark, ["망원역"], fx.station_number)


def test_latitude(spark):
    assert one_col(spark, ["37.123456789", ""], lambda c: fx.blank_decimal(c, 10, 8)) == \
        [Decimal("37.12345679"), None]
    with pytest.raises(Exception):
        one_col(spark, ["127.5"], lambda c: fx.blank_decimal(c, 10, 8))


def _ods(spark, rows):
    full = []
    for r in rows:
        d = {f.name: None for f in ODS_FACT.fields}
        d.update(r)
        full.append(tuple(d[f.name] for f in ODS_FACT.fields))
    return spark.createDataFrame(full, ODS_FACT)


def test_period_filters_differ_on_compact_dates(spark):
    ods = _ods(spark, [{"rent_dt": "2025-01-02", "rent_id": "a"}, {"rent_dt": "20250102", "rent_id": "b"}])
    a = [r.rent_id for r in fact_ops.clean_fact_iso(ods, "2025-01-01", "2025-01-03").collect()]
    b = sorted(r.rent_id for r in fact_ops.clean_fact_any(ods, "2025-01-01", "2025-01-03").collect())
    assert a == ["a"] and b == ["a", "b"]
    dates = {r.rent_dt for r in fact_ops.clean_fact_any(ods, "2025-01-01", "2025-01-03").collect()}
    assert dates == {dt.date(2025, 1, 2)}


def test_impossible_date_raises(spark):
    ods = _ods(spark, [{"rent_dt": "20250230", "rent_id": "a"}])
    with pytest.raises(Exception):
        fact_ops.clean_fact_any(ods, "2025-02-01", "2025-03-01").collect()


def test_all_blank_measures_sum_to_null(spark):
    rows = [{"rent_dt": "2025-01-01", "rent_id": "ST-1", "rent_nm": "1. a", "use_cnt": "",
             "exer_amt": "", "carbon_amt": "", "move_meter": "", "move_time": ""}] * 3
    out = fact_ops.aggregate_fact(fact_ops.clean_fact_iso(_ods(spark, rows), "2025-01-01", "2025-01-01")).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.use_cnt, r.exer_amt, r.carbon_amt, r.move_meter, r.move_time) == (None,) * 5
    assert (r.rent_no, r.rent_nm) == (1, "a")


def test_name_parsed_from_max_after_aggregate(spark):
    rows = [{"rent_dt": "2025-01-01", "rent_id": "ST-1", "rent_nm": "9. zeta", "use_cnt": "1"},
            {"rent_dt": "2025-01-01", "rent_id": "ST-1", "rent_nm": "10. alpha", "use_cnt": "2"}]
    r = fact_ops.aggregate_fact(fact_ops.clean_fact_iso(_ods(spark, rows), "2025-01-01", "2025-01-01")).first()
    # binary max of the raw text is '9. zeta': number and name come from the same row
    assert (r.rent_no, r.rent_nm, r.use_cnt) == (9, "zeta", 3)


@pytest.mark.parametrize("values, total", [
    (["0.3333333333333333"], 0.3333333333333333), (["1e-17"], 1e-17), (["1e-16"] * 3, 3e-16),
    (["1.5", "2.25", ""], 3.75), (["1e300", "1e300"], 2e300), (["inf", "2"], float("inf")), ([""], None),
])
def test_measures_are_plain_double_sums(spark, values, total):
    rows = [{"rent_dt": "2025-01-01", "rent_id": "ST-1", "rent_nm": "1. a", "exer_amt": v} for v in values]
    r = fact_ops.aggregate_fact(fact_ops.clean_fact_iso(_ods(spark, rows), "2025-01-01", "2025-01-01")).first()
    assert r.exer_amt == total


def test_clean_station(spark):
    row = ("", "102. 망원역", "5", "3", "37.123456789", "127.5", "ST-102")
    r = clean_station(spark.createDataFrame([row], ODS_STATION)).first()
    assert r.station_cd == "ST-102" and r.station_no == 102 and r.station_nm == "망원역"
    assert r.station_lat == Decimal("37.12345679") and r.station_lon == Decimal("127.50000000")
    assert r.rack_tot_cnt is None and r.parking_bike_tot_cnt == 5 and r.shared == 3


def test_period_bounds_validation():
    assert fx.iso_text("20250101") == "2025-01-01"
    with pytest.raises(ValueError):
        fx.period_bounds("2025-01-03", "2025-01-01")


@pytest.mark.parametrize("parts", [1, 7])
def test_describe_quartiles_are_exact_at_any_partitioning(spark, parts):
    import numpy as np

    from rental_mart.operators import quality as dq

    x = [float(i * 7 % 5003) for i in range(5003)] + [2.5] * 3000 + [-1e9, 1e9]
    df = spark.createDataFrame([(v, 1, float(i)) for i, v in enumerate([1.0, 2.0, 3.0, 4.0])], "a double, b int, c double")
    few = {r.column_name: r for r in dq.describe(df.repartition(parts)).collect()}
    assert (few["a"].q25, few["a"].q50, few["a"].q75) == (1.75, 2.5, 3.25) and few["b"].q50 == 1.0
    many = dq.describe(spark.createDataFrame([(v,) for v in x] + [(None,)], "x double").repartition(parts)).first()
    assert [many.q25, many.q50, many.q75] == list(np.quantile(x, [0.25, 0.5, 0.75]))
    assert (many["count"], many.null_count) == (len(x), 1)
    none = dq.describe(spark.createDataFrame([(None,)], "x double")).first()
    assert none.q50 is None and none["count"] == 0


def test_nan_text_measure_loads(spark):
    rows = [{"rent_dt": "2025-01-01", "rent_id": "ST-1", "rent_nm": "1. a", "exer_amt": "NaN"},
            {"rent_dt": "2025-01-01", "rent_id": "ST-1", "rent_nm": "1. a", "exer_amt": "2.5"}]
    r = fact_ops.aggregate_fact(fact_ops.clean_fact_iso(_ods(spark, rows), "2025-01-01", "2025-01-01")).first()
    assert r.exer_amt != r.exer_amt   # NaN, as a DOUBLE PRECISION sum gives


def test_describe_text(spark):
    from rental_mart.operators import quality as dq

    df = spark.createDataFrame([("b", dt.date(2024, 1, 2), 1), ("가", None, 2), (None, dt.date(2023, 12, 31), 3)],
                               "s string, d date, n int")
    got = {r.column_name: tuple(r)[1:] for r in dq.describe_text(df).collect()}
    assert got == {"s": (2, 1, "b", "가"), "d": (2, 1, "2023-12-31", "2024-01-02")}
