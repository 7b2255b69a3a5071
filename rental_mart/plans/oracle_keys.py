"""Oracle SQL per registered key (DuckDB dialect, same column names)."""

from __future__ import annotations

from rental_mart.plans import oracle as o
from rental_mart.sources import derived as dv

S, E = dv.PERIOD

ORACLE: dict[str, str] = {
    "fact_clean_iso": f"WITH {o.ODS_FACT}\n{o.clean_iso('ods_fact', S, E)}",
    "fact_clean_any": f"WITH {o.ODS_FACT_MIXED}\n{o.clean_any('ods_fact_mixed', S, E)}",
    "fact_dw_daily": o.fact_dw(o.ODS_FACT, "ods_fact", S, E),
    "fact_dw_daily_any": o.fact_dw(o.ODS_FACT_MIXED, "ods_fact_mixed", S, E, "any"),
    "fact_dw_daily_iso_on_mixed": o.fact_dw(o.ODS_FACT_MIXED, "ods_fact_mixed", S, E),
}

WS, WE = dv.WIDE_PERIOD
ES, EE = dv.EARLY_PERIOD
_LOST = o.ODS_FACT + f""",
ods_fact_lost AS (SELECT * FROM ods_fact WHERE rent_dt <> '{dv.LOST_DAY}')"""
_DW_WIDE = f"""WITH {o.ODS_FACT},
c AS ({o.clean_iso('ods_fact', WS, WE)}),
dw AS ({o.aggregate('c')})
"""

ORACLE.update({
    "fact_refresh_period": o.fact_dw(o.ODS_FACT, "ods_fact", WS, WE),
    "fact_refresh_lost_day": o.fact_dw(_LOST, "ods_fact_lost", WS, WE),
    "fact_insert": f"""WITH {o.ODS_FACT},
a AS ({o.clean_iso('ods_fact', ES, EE)}),
b AS ({o.clean_iso('ods_fact', S, E)})
{o.aggregate('a')}
UNION ALL
{o.aggregate('b')}""",
    "table_count": f"SELECT count(*) AS n_rows FROM ({o.fact_dw(o.ODS_FACT, 'ods_fact', *dv.ALL_DATES)})",
    "mart_daily": _DW_WIDE + o.mart_daily("dw"),
    "mart_station": _DW_WIDE + o.mart_station("dw"),
    "station_clean": f"WITH {o.ods_station()},{o.STATION_SRC}\nSELECT * FROM src",
    "station_upsert": f"WITH {o.ods_station()},{o.STATION_SRC},{o.DW_STATION_SEED}\n"
                      + o.upsert("dw_station", "src"),
    "station_soft_delete": f"WITH {o.ods_station()},{o.STATION_SRC},{o.DW_STATION_SEED}\n"
                           + o.soft_delete("dw_station", "src"),
    "station_soft_delete_null_key": f"WITH {o.ods_station(10)},{o.STATION_SRC},{o.DW_STATION_SEED}\n"
                                    + o.soft_delete("dw_station", "src"),
    "station_load": f"WITH {o.ods_station()},{o.STATION_SRC},{o.DW_STATION_SEED},\n"
                    f"up AS ({o.upsert('dw_station', 'src')})\n" + o.soft_delete("up", "src"),
    "station_active_count": f"WITH {o.ods_station()},{o.STATION_SRC},{o.DW_STATION_SEED},\n"
                            f"up AS ({o.upsert('dw_station', 'src')}),\n"
                            f"ld AS ({o.soft_delete('up', 'src')})\n"
                            "SELECT count(*) AS n_active FROM ld WHERE is_deleted = FALSE",
})

_FACT_COLS = ("rent_dt rent_id rent_nm rent_type gender_cd age_type use_cnt exer_amt carbon_amt "
              "move_meter move_time start_index end_index rnum").split()
_API = ", ".join(f"{c} AS {c.upper()}" for c in _FACT_COLS)
_STATION_API = ("racktotcnt AS rackTotCnt, stationname AS stationName, parkingbiketotcnt AS parkingBikeTotCnt, "
                "shared, stationlatitude AS stationLatitude, stationlongitude AS stationLongitude, "
                "stationid AS stationId")
_LINEITEM = ("l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
             "l_returnflag l_linestatus l_shipdate").split()
_LINEITEM_NUM = _LINEITEM[:8]
_ORDERS_N = "(SELECT count(*) FROM orders)"


def _describe_sql() -> str:
    parts = []
    for c in _LINEITEM_NUM:
        x = f"CAST({c} AS DOUBLE)"
        q = [f"quantile_cont({x}, {p})" for p in (0.25, 0.5, 0.75)]
        parts.append(f"""SELECT '{c}' AS column_name, count({x}) AS count,
  count(*) FILTER (WHERE {c} IS NULL) AS null_count,
  avg({x}) AS mean,
  stddev_samp({x}) AS std, min({x}) AS min,
  {q[0]} AS q25, {q[1]} AS q50, {q[2]} AS q75, max({x}) AS max FROM lineitem""")
    return "\nUNION ALL\n".join(parts)


def _page_audit_sql() -> str:
    pages = f"CAST(ceil({_ORDERS_N} / 1000.0) AS BIGINT)"
    cut_rows = f"least(7000, {_ORDERS_N})"
    return f"""
SELECT 'orders' AS service, '20240101' AS rent_dt, {pages} AS pages_landed, {pages} AS pages_read,
  {_ORDERS_N} AS rows_collected, {_ORDERS_N} AS list_total_count, TRUE AS is_complete
UNION ALL
SELECT 'orders', '20240102', {pages}, least(CAST(7 AS BIGINT), {pages}),
  {cut_rows}, {_ORDERS_N}, {cut_rows} = {_ORDERS_N}"""


_SPARK_TYPE = """CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int'
  WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END"""

ORACLE.update({
    "land_fact_readback": f"WITH {o.ODS_FACT}\nSELECT {_API} FROM ods_fact",
    "land_fact_period_readback": f"WITH {o.ODS_FACT}\nSELECT {_API} FROM ods_fact WHERE rent_dt BETWEEN '{S}' AND '{E}'",
    "land_relanding": f"WITH {o.ODS_FACT}\nSELECT {_API} FROM ods_fact",
    "land_by_request_day": f"""WITH {o.ODS_FACT}
SELECT CASE WHEN rent_dt = '{S}' AND CAST(rnum AS BIGINT) % 10 = 0 THEN '{dv.LOST_DAY}'
            WHEN rent_dt = '{S}' AND CAST(rnum AS BIGINT) % 10 = 1 THEN NULL ELSE rent_dt END AS rent_dt,
  * EXCLUDE (rent_dt) FROM ods_fact""",
    "lower_names": f"WITH {o.ODS_FACT}\nSELECT * FROM ods_fact",
    "land_snapshot_readback": f"WITH {o.ods_station()}\nSELECT {_STATION_API} FROM ods_station",
    "ods_reload": f"WITH {o.ODS_FACT}\nSELECT * FROM ods_fact",
    "ods_empty_guard": f"WITH {o.ods_station()}\nSELECT * FROM ods_station",
    "preview_shape": "SELECT count(*) AS n_rows, 11 AS n_cols FROM lineitem",
    "pages_unpack_fact": "SELECT * FROM orders",
    "pages_unpack_fact_stop": "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS rn "
                              "FROM orders) WHERE rn <= 7000",
    "pages_unpack_dim": "SELECT * FROM orders",
    "page_ranges": """
WITH totals AS (SELECT strftime(o_orderdate, '%Y%m%d') AS rent_dt, count(*) AS list_total_count
                FROM orders GROUP BY 1),
r AS (SELECT rent_dt, list_total_count,
             unnest(generate_series(CAST(1 AS BIGINT), greatest(list_total_count, 1), CAST(1000 AS BIGINT))) AS start_index
      FROM totals)
SELECT rent_dt, list_total_count, start_index, start_index + 999 AS end_index FROM r""",
    "page_audit": _page_audit_sql(),
    "landing_gate": f"""
SELECT CAST(2 AS BIGINT) AS responses, CAST({_ORDERS_N} > 7000 AS BIGINT) AS truncated,
  2 * {_ORDERS_N} AS rows_announced, {_ORDERS_N} + least(7000, {_ORDERS_N}) AS rows_collected,
  CASE WHEN {_ORDERS_N} > 7000 THEN 'orders 20240102' END AS first_truncated,
  {_ORDERS_N} + least(7000, {_ORDERS_N}) AS rows_landed""",
    "date_spine": """
SELECT strftime(d, '%Y%m%d') AS rent_dt FROM (
  SELECT unnest(generate_series(CAST(min(ts) AS DATE), CAST(max(ts) AS DATE), INTERVAL 1 DAY)) AS d FROM events)""",
    "rows_per_day": f"""WITH {o.ODS_FACT},
lost AS (SELECT * FROM ods_fact WHERE rent_dt <> '{dv.LOST_DAY}'),
c AS (SELECT CAST(try_strptime(replace(rent_dt, '-', ''), '%Y%m%d') AS DATE) AS d, count(*) AS n FROM lost GROUP BY 1),
spine AS (SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d FROM c)
SELECT coalesce(s.d, c.d) AS rent_dt, coalesce(c.n, 0) AS n_rows FROM spine s FULL OUTER JOIN c ON s.d = c.d""",
    "schema_list": f"""
SELECT CAST(ordinal_position AS INTEGER) AS position, column_name, {_SPARK_TYPE} AS data_type,
  is_nullable = 'YES' AS nullable
FROM information_schema.columns WHERE table_name = 'lineitem'""",
    "null_counts": "SELECT " + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in _LINEITEM)
                   + " FROM lineitem",
    "describe": _describe_sql(),
    "constraint_audit": f"""WITH {o.ODS_FACT},
c AS ({o.clean_iso('ods_fact', *dv.ALL_DATES)}),
dw AS ({o.aggregate('c')}),
dw2 AS (SELECT * FROM dw UNION ALL SELECT * FROM dw),
k AS (SELECT rent_dt, rent_id, rent_type, gender_cd, age_type, count(*) AS n FROM dw2
      GROUP BY rent_dt, rent_id, rent_type, gender_cd, age_type)
SELECT CAST(sum(n) AS BIGINT) AS n_rows,
  CAST(coalesce(sum(CASE WHEN rent_dt IS NULL THEN n ELSE 0 END), 0) AS BIGINT) AS null_rent_dt,
  CAST(coalesce(sum(CASE WHEN rent_id IS NULL THEN n ELSE 0 END), 0) AS BIGINT) AS null_rent_id,
  CAST(coalesce(sum(CASE WHEN rent_type IS NULL THEN n ELSE 0 END), 0) AS BIGINT) AS null_rent_type,
  CAST(coalesce(sum(CASE WHEN gender_cd IS NULL THEN n ELSE 0 END), 0) AS BIGINT) AS null_gender_cd,
  CAST(coalesce(sum(CASE WHEN age_type IS NULL THEN n ELSE 0 END), 0) AS BIGINT) AS null_age_type,
  CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS dup_pk_groups,
  CAST(coalesce(sum(CASE WHEN n > 1 THEN n ELSE 0 END), 0) AS BIGINT) AS dup_pk_rows,
  CAST(coalesce(sum(CASE WHEN length(rent_id) > 50 THEN n ELSE 0 END), 0) AS BIGINT) AS long_rent_id,
  CAST(coalesce(sum(CASE WHEN length(rent_type) > 50 THEN n ELSE 0 END), 0) AS BIGINT) AS long_rent_type,
  CAST(coalesce(sum(CASE WHEN length(gender_cd) > 20 THEN n ELSE 0 END), 0) AS BIGINT) AS long_gender_cd,
  CAST(coalesce(sum(CASE WHEN length(age_type) > 20 THEN n ELSE 0 END), 0) AS BIGINT) AS long_age_type
FROM k""",
})

ORACLE["fact_dw_daily_sql"] = ORACLE["fact_dw_daily"]

_ALL_DW = o.fact_dw(o.ODS_FACT, "ods_fact", *dv.ALL_DATES)
ORACLE["stream_dw_refresh"] = _ALL_DW
_AUDIT = f"{o.TS_LOAD} AS created_at, {o.TS_LOAD} AS last_updated"
ORACLE["fact_dw_audit"] = f"SELECT *, {_AUDIT} FROM ({_ALL_DW})"
ORACLE["fact_dw_by_name"] = f"SELECT *, {_AUDIT}, count(*) OVER () AS by_name FROM ({_ALL_DW})"
ORACLE["stream_dw_late_rows"] = o.fact_dw(o.ODS_FACT + f""",
ods_fact_kept AS (SELECT * FROM ods_fact WHERE NOT (CAST(rnum AS BIGINT) % 10 = 0
  AND CAST(rent_dt AS DATE) = DATE '{dv.LOST_DAY}' - 1))""", "ods_fact_kept", *dv.ALL_DATES)
ORACLE["fact_job_late_rows"] = ORACLE["fact_dw_daily"]
ORACLE["ods_by_day"] = ORACLE["ods_reload"]
ORACLE["layout_profile"] = f"""WITH {o.ODS_FACT}
SELECT concat('year=', rent_dt[1:4], '/month=', rent_dt[6:7], '/day=', rent_dt[9:10]) AS folder,
  count(*) AS n_rows, CAST(0 AS BIGINT) AS n_above, TRUE AS enough_files
FROM ods_fact GROUP BY rent_dt"""

ORACLE["fact_end_to_end"] = ORACLE["fact_dw_daily"]
ORACLE["station_end_to_end"] = ORACLE["station_load"]

ORACLE["preview_rows"] = ("SELECT * FROM lineitem ORDER BY "
                          + ", ".join(f"{c} ASC NULLS FIRST" for c in _LINEITEM) + " LIMIT 5")

ORACLE["stream_station_refresh"] = ORACLE["station_load"]

_ODS_TEXT = [c for c in _FACT_COLS if c not in ("start_index", "end_index")]
ORACLE["describe_text"] = f"WITH {o.ODS_FACT}\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count({c}) AS count, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
    f"min({c}) AS min, max({c}) AS max FROM ods_fact" for c in _ODS_TEXT)
