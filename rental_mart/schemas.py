"""Declared schemas of every layer. Landed data is never schema-inferred."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()
I = T.IntegerType()
D = T.DoubleType()
TS = T.TimestampNTZType()  # the warehouse's TIMESTAMP has no time zone

# ---- fixed values: the source system's page size and field names -------------------
PAGE_SIZE = 1000  # rows per API page

# API rows as the service returns them (names before lower-casing)
FACT_API_ROW = T.StructType(
    [T.StructField(n, S) for n in (
        "RENT_DT", "RENT_ID", "RENT_NM", "RENT_TYPE", "GENDER_CD", "AGE_TYPE",
        "USE_CNT", "EXER_AMT", "CARBON_AMT", "MOVE_METER", "MOVE_TIME")]
    + [T.StructField("START_INDEX", L), T.StructField("END_INDEX", L), T.StructField("RNUM", S)]
)

STATION_API_ROW = T.StructType(
    [T.StructField(n, S) for n in (
        "rackTotCnt", "stationName", "parkingBikeTotCnt", "shared",
        "stationLatitude", "stationLongitude", "stationId")]
)

# ---- end of fixed values ------------------------------------------------------------

# ---- landed page: one row per API response ----------------------------------------
LANDED_PAGE = T.StructType([
    T.StructField("service", S),
    T.StructField("rent_dt", S),          # yyyyMMdd; NULL for the dimension
    T.StructField("start_index", L),
    T.StructField("end_index", L),
    T.StructField("body", S),
])

# ---- ODS: raw text (fixed values: the declared ODS column names) ---------------------
ODS_FACT = T.StructType(
    [T.StructField(n, S) for n in (
        "rent_dt", "rent_id", "rent_nm", "rent_type", "gender_cd", "age_type",
        "use_cnt", "exer_amt", "carbon_amt", "move_meter", "move_time")]
    + [T.StructField("start_index", L), T.StructField("end_index", L), T.StructField("rnum", S)]
)

ODS_STATION = T.StructType(
    [T.StructField(n, S) for n in (
        "racktotcnt", "stationname", "parkingbiketotcnt", "shared",
        "stationlatitude", "stationlongitude", "stationid")]
)

# ---- DW ---------------------------------------------------------------------------
FACT_KEYS = ("rent_dt", "rent_id", "rent_type", "gender_cd", "age_type")
FACT_MEASURES = ("use_cnt", "exer_amt", "carbon_amt", "move_meter", "move_time")

CLEAN_FACT = T.StructType([
    T.StructField("rent_dt", T.DateType()),
    T.StructField("rent_id", S),
    T.StructField("rent_nm", S),
    T.StructField("rent_type", S),
    T.StructField("gender_cd", S),
    T.StructField("age_type", S),
    T.StructField("use_cnt", I),
    T.StructField("exer_amt", D),
    T.StructField("carbon_amt", D),
    T.StructField("move_meter", D),
    T.StructField("move_time", I),
])

DW_FACT = T.StructType([
    T.StructField("rent_dt", T.DateType()),
    T.StructField("rent_id", S),
    T.StructField("rent_no", I),
    T.StructField("rent_nm", S),
    T.StructField("rent_type", S),
    T.StructField("gender_cd", S),
    T.StructField("age_type", S),
    T.StructField("use_cnt", L),
    T.StructField("exer_amt", D),
    T.StructField("carbon_amt", D),
    T.StructField("move_meter", D),
    T.StructField("move_time", L),
    T.StructField("created_at", TS),
    T.StructField("last_updated", TS),
])

# declared VARCHAR limits of the DW fact key columns
FACT_VARCHAR_LIMITS = {"rent_id": 50, "rent_type": 50, "gender_cd": 20, "age_type": 20}

DW_STATION = T.StructType([
    T.StructField("station_cd", S),
    T.StructField("station_no", I),
    T.StructField("station_nm", S),
    T.StructField("station_lat", T.DecimalType(10, 8)),
    T.StructField("station_lon", T.DecimalType(11, 8)),
    T.StructField("rack_tot_cnt", I),
    T.StructField("parking_bike_tot_cnt", I),
    T.StructField("shared", I),
    T.StructField("created_at", TS),
    T.StructField("last_updated", TS),
    T.StructField("is_deleted", T.BooleanType()),
])

STATION_ATTRS = ("station_no", "station_nm", "station_lat", "station_lon",
                 "rack_tot_cnt", "parking_bike_tot_cnt", "shared")


def names(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields]


def without(schema: T.StructType, *drop: str) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name not in drop])
