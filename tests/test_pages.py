"""Round trip rows -> pages -> rows, and the two stop rules."""

from __future__ import annotations

import json

import pytest

from rental_mart.schemas import LANDED_PAGE
from rental_mart.sources import derived as dv
from rental_mart.sources import pages as pg

from conftest import SF001, SF01

ROW = "id string, v string"


def page(service, day, start, rows, total, root=None):
    body = json.dumps({root or service: {"list_total_count": total, "row": rows}})
    return (service, day, start, start + 999, body)


def rows_of(n0, n):
    return [{"id": str(i), "v": f"v{i}"} for i in range(n0, n0 + n)]


def ids(df):
    return sorted(int(r.id) for r in df.collect())


def landed(spark, items):
    return spark.createDataFrame(items, LANDED_PAGE)


def schema(spark):
    return spark.createDataFrame([], ROW).schema


def test_round_trip_orders(spark):
    p = dv.orders_pages(spark, SF01)
    assert p.count() == 15
    out = pg.unpack_pages_fact(p, dv.orders_row_schema(spark, SF01))
    src = dv.table(spark, SF01, "orders")
    assert out.count() == 15000
    assert out.exceptAll(src).count() == 0 and src.exceptAll(out).count() == 0


def test_fact_stops_at_result_and_after_total(spark):
    items = [page("svc", "20250101", 1, rows_of(0, 1000), 2500),
             page("svc", "20250101", 1001, rows_of(1000, 1000), 2500),
             ("svc", "20250101", 2001, 3000, json.dumps({"RESULT": {"CODE": "INFO-200"}})),
             page("svc", "20250101", 3001, rows_of(3000, 10), 2500)]
    assert ids(pg.unpack_pages_fact(landed(spark, items), schema(spark))) == list(range(2000))
    # the page whose requested end reaches the total is the last one read
    items = [page("svc", "d2", 1, rows_of(0, 1000), 1000), page("svc", "d2", 1001, rows_of(1000, 5), 1000)]
    assert ids(pg.unpack_pages_fact(landed(spark, items), schema(spark))) == list(range(1000))


def test_fact_missing_page_stops(spark):
    items = [page("svc", "d", 1, rows_of(0, 1000), 3000), page("svc", "d", 2001, rows_of(2000, 1000), 3000)]
    assert ids(pg.unpack_pages_fact(landed(spark, items), schema(spark))) == list(range(1000))
    items = [page("svc", "d", 1001, rows_of(1000, 1000), 3000)]
    assert pg.unpack_pages_fact(landed(spark, items), schema(spark)).count() == 0


@pytest.mark.parametrize("bad", ["", None, "{}", "not json", json.dumps({"svc": {"list_total_count": 9, "row": []}})])
def test_fact_bad_page_stops(spark, bad):
    items = [page("svc", "d", 1, rows_of(0, 1000), 3000), ("svc", "d", 1001, 2000, bad),
             page("svc", "d", 2001, rows_of(2000, 1000), 3000)]
    assert ids(pg.unpack_pages_fact(landed(spark, items), schema(spark))) == list(range(1000))


def test_groups_are_independent(spark):
    items = [page("svc", "a", 1, rows_of(0, 3), 3),
             ("svc", "b", 1, 1000, json.dumps({"RESULT": {}})),
             page("svc", "c", 1, rows_of(10, 2), 2)]
    assert ids(pg.unpack_pages_fact(landed(spark, items), schema(spark))) == [0, 1, 2, 10, 11]


def test_dim_rules(spark):
    items = [page("bike", None, 1, rows_of(0, 1000), 0),
             page("bike", None, 1001, rows_of(1000, 999), 0),      # short page: last one read
             page("bike", None, 2001, rows_of(2000, 1000), 0)]
    assert ids(pg.unpack_pages_dim(landed(spark, items), schema(spark))) == list(range(1999))
    # any RESULT key stops the dimension, even when it is not the first key
    body = json.dumps({"bike": {"list_total_count": 5, "row": rows_of(0, 1000)}, "RESULT": {"CODE": "x"}})
    items = [page("bike", None, 1, rows_of(5000, 1000), 0), ("bike", None, 1001, 2000, body)]
    assert ids(pg.unpack_pages_dim(landed(spark, items), schema(spark))) == list(range(5000, 6000))
    # ... but the fact rule only looks at the first key
    assert len(ids(pg.unpack_pages_fact(landed(spark, [("s", "d", 1, 1000, body)]), schema(spark)))) == 1000
    # a root value that is not an object stops
    items = [page("bike", None, 1, rows_of(0, 1000), 0), ("bike", None, 1001, 2000, json.dumps({"bike": [1, 2]}))]
    assert ids(pg.unpack_pages_dim(landed(spark, items), schema(spark))) == list(range(1000))


def test_page_ranges(spark):
    t = spark.createDataFrame([("a", 0), ("b", 1000), ("c", 1001)], "k string, list_total_count long")
    got = sorted((r.k, r.start_index, r.end_index) for r in pg.page_ranges(t).collect())
    assert got == [("a", 1, 1000), ("b", 1, 1000), ("c", 1, 1000), ("c", 1001, 2000)]


def test_page_audit_reports_truncation(spark):
    p = dv.with_result_page(dv.orders_pages(spark, SF01), 8)
    r = pg.page_audit(p, dv.orders_row_schema(spark, SF01)).first()
    assert (r.pages_landed, r.pages_read, r.rows_collected, r.list_total_count, r.is_complete) == \
        (15, 7, 7000, 15000, False)


def test_small_scale_pages(spark):
    p = dv.orders_pages(spark, SF001)
    assert pg.unpack_pages_dim(p, dv.orders_row_schema(spark, SF001)).count() == \
        dv.table(spark, SF001, "orders").count()


def test_total_as_text_and_unaligned_pages(spark):
    body = json.dumps({"svc": {"list_total_count": "1500", "row": rows_of(0, 1000)}})
    items = [("svc", "d", 1, 1000, body),
             page("svc", "d", 500, rows_of(9000, 5), 1500),       # never requested: ignored
             page("svc", "d", 1001, rows_of(1000, 500), 1500)]
    assert ids(pg.unpack_pages_fact(landed(spark, items), schema(spark))) == list(range(1500))


def test_keep_meta_positions(spark):
    items = [page("svc", "d", 1, rows_of(0, 3), 3)]
    out = pg.unpack_pages_fact(landed(spark, items), schema(spark), keep_meta=True).collect()
    assert [(r.service, r.rent_dt, r.start_index, r.row_pos, r.id) for r in out] == \
        [("svc", "d", 1, i, str(i)) for i in range(3)]


def test_only_the_first_root_value_matters(spark):
    good = {"list_total_count": 1000, "row": rows_of(0, 1000)}
    items = [("svc", "d", 1, 1000, json.dumps({"svc": good, "extra": 5})),
             ("svc", "d", 1001, 2000, json.dumps({"svc": {"list_total_count": 3000, "row": rows_of(1000, 5)}}))]
    assert ids(pg.unpack_pages_fact(landed(spark, items), schema(spark))) == list(range(1000))
    # a first root value that is not an object stops the dimension
    items = [page("bike", None, 1, rows_of(0, 1000), 0),
             ("bike", None, 1001, 2000, json.dumps({"bike": [{"list_total_count": 1}]})),
             page("bike", None, 2001, rows_of(2000, 3), 0)]
    assert ids(pg.unpack_pages_dim(landed(spark, items), schema(spark))) == list(range(1000))


def test_field_json_types_do_not_void_a_page(spark):
    import pytest
    from pyspark.sql import types as T

    typed = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType())])
    rows = [{"id": "a", "n": 1}, {"id": "b", "n": "2"}, {"id": "c", "n": None}, {"id": 7, "n": 3}]
    items = [("svc", "d", 1, 1000, json.dumps({"svc": {"list_total_count": 4, "row": rows}}))]
    got = sorted((r.id, r.n) for r in pg.unpack_pages_fact(landed(spark, items), typed).collect())
    assert got == [("7", 3), ("a", 1), ("b", 2), ("c", None)]
    bad = [("svc", "d", 1, 1000, json.dumps({"svc": {"list_total_count": 1, "row": [{"id": "x", "n": "abc"}]}}))]
    with pytest.raises(Exception):
        pg.unpack_pages_fact(landed(spark, bad), typed).collect()


def test_page_landed_twice_fails(spark):
    import pytest

    items = [page("svc", "d", 1, rows_of(0, 1000), 2000), page("svc", "d", 1, rows_of(0, 1000), 2000),
             page("svc", "d", 1001, rows_of(1000, 1000), 2000)]
    with pytest.raises(Exception, match="more than once"):
        pg.unpack_pages_fact(landed(spark, items), schema(spark)).collect()


def _two_days(spark):
    cut = [page("svc", "d2", 1, rows_of(0, 1000), 2500), page("svc", "d2", 1001, rows_of(1000, 1000), 2500)]
    return landed(spark, [page("svc", "d1", 1, rows_of(0, 3), 3), *cut,
                          ("svc", "d3", 1, 1000, json.dumps({"RESULT": {"CODE": "INFO-200"}}))])


def test_gate_reports_truncated_responses_in_the_write(spark, tmp_path):
    from pyspark.sql import Observation

    seen = Observation()
    rows = pg.unpack_pages_fact(_two_days(spark), schema(spark), observation=seen)
    rows.write.parquet(f"{tmp_path}/rows")
    assert seen.get == {"responses": 2, "truncated": 1, "rows_announced": 2503, "rows_collected": 2003,
                        "first_truncated": "svc d2"}
    assert spark.read.parquet(f"{tmp_path}/rows").count() == 2003


def test_gate_of_no_pages_reports_zeros(spark):
    from pyspark.sql import Observation

    seen = Observation()
    assert pg.unpack_pages_fact(landed(spark, []), schema(spark), observation=seen).collect() == []
    assert seen.get["responses"] == 0 and seen.get["rows_announced"] == 0 and seen.get["first_truncated"] is None


def test_gate_refuses_before_anything_is_landed(spark, tmp_path):
    from rental_mart.sources import lake

    rows = pg.unpack_pages_fact(_two_days(spark), schema(spark), day_as="_day", refuse_truncated=True)
    with pytest.raises(Exception, match="truncated response: svc d2 has 2000 of 2500 rows"):
        lake.land_fact(rows, str(tmp_path), "svc", date_col="_day", keep_day=False)
    assert not [f for f in tmp_path.rglob("*.parquet") if "_temporary" not in str(f) and ".spark-staging" not in str(f)]
    whole = _two_days(spark).where("rent_dt <> 'd2'")
    assert ids(pg.unpack_pages_fact(whole, schema(spark), refuse_truncated=True)) == [0, 1, 2]


@pytest.mark.parametrize("mode", ["fact", "dim"])
def test_many_pages_of_one_day_are_read_range_by_range(spark, mode):
    n = 2 * pg.PAGES_TOGETHER + 3
    day = "d" if mode == "fact" else None
    items = [("svc", day, 1 + 2 * k, 2 + 2 * k, json.dumps({"svc": {"list_total_count": 2 * n, "row": rows_of(2 * k, 2)}}))
             for k in range(n)]
    for stop in (n, pg.PAGES_TOGETHER + 1, pg.PAGES_TOGETHER, 1):
        cut = items[:stop] + items[stop + 1:]
        out = pg.unpack_pages(landed(spark, cut), schema(spark), mode, page_size=2)
        assert ids(out) == list(range(2 * stop))


def test_pages_are_numbered_by_day_over_ranges(spark):
    days = [("a", 2500), ("b", 1), (None, 1300), ("c", 1000)]
    rows = spark.createDataFrame([(d, f"{d}{i:05d}") for d, n in days for i in range(n)], "day string, id string").repartition(5)
    numbered = dv.day_positions(spark, rows, "day", "id", n_ranges=7).collect()
    assert sorted((str(r.day), r.pos, r.id, r.day_rows) for r in numbered) == \
        sorted((str(d), i + 1, f"{d}{i:05d}", n) for d, n in days for i in range(n))
    got = dv.pack_pages(spark, rows, "id", "svc", rows["day"]).collect()
    pages = {(p.rent_dt, p.start_index, p.end_index): json.loads(p.body)["svc"] for p in got}
    assert sorted(pages, key=str) == sorted(((d, s, s + 999) for d, n in days for s in range(1, n + 1, 1000)), key=str)
    for (d, start, end), body in pages.items():
        n = dict(days)[d]
        assert body["list_total_count"] == n
        assert [r["id"] for r in body["row"]] == [f"{d}{i:05d}" for i in range(start - 1, min(end, n))]
