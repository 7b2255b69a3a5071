"""Source-shaped views derived from the driver's tables.

The warehouse's real inputs (landed API pages, ODS text tables, an existing
station dimension) are built here from the given Parquet tables with plain
projections, so every derived view grows with its table. Measures are built
from integers and quarters, so their text forms and double sums are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rental_mart.schemas import LANDED_PAGE, ODS_FACT, PAGE_SIZE, names
from rental_mart.session import ensure_checkpoint_dir, scratch_path

# test period and the load time used by the fixture loads
PERIOD = ("2024-01-10", "2024-01-16")
WIDE_PERIOD = ("2024-01-08", "2024-01-20")
ALL_DATES = ("0001-01-01", "9999-12-31")  # bounds that every date is within
EARLY_PERIOD = ("2024-01-01", "2024-01-05")
LOST_DAY = "2024-01-12"
LOAD_TS = "2024-02-01 00:00:00"
SEED_TS = "2024-01-01 00:00:00"


_SCHEMAS: dict[str, object] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Its schema is read from the file footer once per path and
    then declared, so building a query does not re-read footers every time."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = _SCHEMAS.get(path)
    if schema is None:
        schema = _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(schema).parquet(path)


def _s(c) -> F.Column:
    return c.cast("string")


def ods_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ODS fact text rows, one per event."""
    ev = table(spark, sf_dir, "events")
    eid, uid = F.col("event_id"), F.col("user_id")
    station = _s(uid % 50)
    return ev.select(
        _s(F.col("ts").cast("date")).alias("rent_dt"),
        F.concat(F.lit("ST-"), station).alias("rent_id"),
        F.concat(_s(100 + uid % 50), F.lit(". Station "), station).alias("rent_nm"),
        F.when(eid % 7 == 0, F.lit(" "))
         .when(eid % 7 == 1, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit(" "), F.col("event_type"), F.lit(" "))).alias("rent_type"),
        F.when(eid % 5 == 0, F.lit("f")).when(eid % 5 == 1, F.lit(" M "))
         .when(eid % 5 == 2, F.lit("")).when(eid % 5 == 3, F.lit(None).cast("string"))
         .otherwise(F.lit("F")).alias("gender_cd"),
        F.when(eid % 6 == 0, F.lit("")).when(eid % 6 == 1, F.lit("기타"))
         .when(eid % 6 == 2, F.lit(None).cast("string")).when(eid % 6 == 3, F.lit(" 20대 "))
         .otherwise(F.lit("30대")).alias("age_type"),
        F.when(eid % 11 == 0, F.lit("")).otherwise(_s(1 + eid % 3)).alias("use_cnt"),
        F.when(eid % 13 == 0, F.lit("")).otherwise(_s(F.floor(F.col("value") * 4) / 4)).alias("exer_amt"),
        _s(eid % 97).alias("carbon_amt"),
        _s(eid % 5000).alias("move_meter"),
        _s(eid % 60).alias("move_time"),
        F.lit(1).cast("bigint").alias("start_index"),
        F.lit(1000).cast("bigint").alias("end_index"),
        _s(eid + 1).alias("rnum"),
    )


def ods_fact_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same rows; every even ``rnum`` carries its date as compact 'yyyyMMdd'."""
    o = ods_fact(spark, sf_dir)
    mixed = F.when(F.col("rnum").cast("int") % 2 == 0, F.replace("rent_dt", F.lit("-"), F.lit(""))) \
             .otherwise(F.col("rent_dt"))
    return o.withColumn("rent_dt", mixed).select(*names(ODS_FACT))


def ods_fact_without_day(spark: SparkSession, sf_dir: str, day: str = LOST_DAY) -> DataFrame:
    """ODS fact with every row of one day gone (a reload where a day lost its rows)."""
    o = ods_fact(spark, sf_dir)
    return o.where(F.col("rent_dt") != F.lit(day))


def fact_api_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ODS fact rows as the API returns them (upper-case names)."""
    o = ods_fact(spark, sf_dir)
    return o.select(*[F.col(c).alias(c.upper()) for c in names(ODS_FACT)])


def ods_station(spark: SparkSession, sf_dir: str, null_key_every: int | None = None) -> DataFrame:
    """ODS station text rows, one per supplier. With ``null_key_every=n`` every
    supplier with key % n == n - 1 has a NULL station id."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    sid = F.concat(F.lit("ST-"), _s(k))
    if null_key_every:
        sid = F.when(k % null_key_every == null_key_every - 1, F.lit(None).cast("string")).otherwise(sid)
    return s.select(
        F.when(k % 9 == 0, F.lit("")).otherwise(_s(k % 40)).alias("racktotcnt"),
        F.concat(_s(k), F.lit(". "), F.col("s_name")).alias("stationname"),
        _s(k % 17).alias("parkingbiketotcnt"),
        _s(k % 100).alias("shared"),
        F.when(k % 8 == 0, F.lit("")).otherwise(F.concat(F.lit("37."), _s(500 + k % 100))).alias("stationlatitude"),
        F.concat(F.lit("127."), _s(100 + k % 100)).alias("stationlongitude"),
        sid.alias("stationid"),
    )


def station_api_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station rows with the API's camel-case names."""
    api = {"racktotcnt": "rackTotCnt", "stationname": "stationName",
           "parkingbiketotcnt": "parkingBikeTotCnt", "shared": "shared",
           "stationlatitude": "stationLatitude", "stationlongitude": "stationLongitude",
           "stationid": "stationId"}
    o = ods_station(spark, sf_dir)
    return o.select(*[F.col(c).alias(a) for c, a in api.items()])


def dw_station_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An existing DW station table: some stations to update, some to revive,
    some gone from the source, some already deleted."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    seed = F.lit(SEED_TS).cast("timestamp_ntz")
    k = F.col("s_suppkey")
    a = s.where(k % 3 != 0).select(
        F.concat(F.lit("ST-"), _s(k)).alias("station_cd"),
        k.cast("int").alias("station_no"),
        F.concat(F.lit("old "), F.col("s_name")).alias("station_nm"),
        F.lit(None).cast("decimal(10,8)").alias("station_lat"),
        F.lit(None).cast("decimal(11,8)").alias("station_lon"),
        F.lit(1).alias("rack_tot_cnt"),
        F.lit(None).cast("int").alias("parking_bike_tot_cnt"),
        F.lit(None).cast("int").alias("shared"),
        seed.alias("created_at"), seed.alias("last_updated"),
        (k % 5 == 0).alias("is_deleted"),
    )
    nk = F.col("n_nationkey")
    b = n.select(
        F.concat(F.lit("OLD-"), _s(nk)).alias("station_cd"),
        nk.cast("int").alias("station_no"),
        F.col("n_name").alias("station_nm"),
        F.lit(None).cast("decimal(10,8)").alias("station_lat"),
        F.lit(None).cast("decimal(11,8)").alias("station_lon"),
        F.lit(2).alias("rack_tot_cnt"),
        F.lit(None).cast("int").alias("parking_bike_tot_cnt"),
        F.lit(None).cast("int").alias("shared"),
        seed.alias("created_at"), seed.alias("last_updated"),
        (nk % 4 == 0).alias("is_deleted"),
    )
    return a.unionByName(b)


# ---- landed pages built from ``orders`` -------------------------------------------


ORDERS_SERVICE = "orders"
PAGES_DAY = "20240101"


def day_positions(spark: SparkSession, df: DataFrame, day: str, order: str,
                  n_ranges: int | None = None) -> DataFrame:
    """Adds ``pos``, the 1-based rank of each row by ``order`` (unique) within its ``day``
    (NULL is a day of its own), and ``day_rows``, the number of rows of that day.

    A distributed row numbering: range-partition by (day, order), checkpoint so
    partition ids are pinned, count rows per (day, range), then number the rows of
    each (day, range) and add the day's rows in earlier ranges. The counts are joined
    by (day, range) as well: a day of any length is as many keys as it spans ranges,
    so no step holds more than one range."""
    ensure_checkpoint_dir(spark)
    n = n_ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, day, order).select(
        "*", F.spark_partition_id().alias("_range"),
        F.coalesce(F.concat(F.lit("d"), F.col(day)), F.lit("")).alias("_part"))   # a join key that is never NULL
    ranged = ranged.checkpoint(eager=True)
    of_day = Window.partitionBy("_part")
    before = of_day.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("_part", "_range").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_part", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
                           F.sum("_n").over(of_day).alias("day_rows"))
    rank = F.row_number().over(Window.partitionBy("_part", "_range").orderBy(order))
    return (ranged.withColumn("_rank", rank).join(offsets, ["_part", "_range"])
            .select(*df.columns, (F.col("_offset") + F.col("_rank")).alias("pos"), "day_rows"))


def pack_pages(spark: SparkSession, rows: DataFrame, order_col, service: str,
               day=None, page_size: int = PAGE_SIZE) -> DataFrame:
    """Rows as landed API responses: per (service, day) the rows are numbered by
    ``order_col``, cut into pages of ``page_size`` and each page becomes
    body = {service: {list_total_count: rows of that day, row: [...]}}.

    ``order_col`` is a column name or expression (unique within a day); ``day``
    is a column (or text) giving the request date, None for a dimension.
    Rows are numbered by ranges of each day (``day_positions``), so no day is
    numbered, joined or counted inside a single task."""
    cols = rows.columns
    order = F.col(order_col) if isinstance(order_col, str) else order_col
    day_col = F.lit(None).cast("string") if day is None else (
        F.lit(day) if isinstance(day, str) else day).cast("string")
    keyed = rows.select(F.lit(service).alias("_svc"), day_col.alias("_day"), *cols, order.alias("_order"))
    numbered = day_positions(spark, keyed, "_day", "_order")
    paged = numbered.withColumn("page_no", F.floor((F.col("pos") - 1) / page_size) + 1)
    grouped = paged.groupBy("_svc", "_day", "page_no").agg(
        F.max("day_rows").alias("_total"),
        F.sort_array(F.collect_list(F.struct(F.col("pos"), F.struct(*cols).alias("r")))).alias("items"))
    body = F.to_json(F.create_map(F.col("_svc"), F.struct(
        F.col("_total").cast("long").alias("list_total_count"),
        F.transform("items", lambda x: x["r"]).alias("row"))))
    start = (F.col("page_no") - 1) * page_size + 1
    return grouped.select(
        F.col("_svc").alias("service"), F.col("_day").alias("rent_dt"),
        start.cast("long").alias("start_index"),
        (start + page_size - 1).cast("long").alias("end_index"),
        body.alias("body"),
    )


def orders_pages(spark: SparkSession, sf_dir: str, rent_dt: str | None = PAGES_DAY,
                 service: str = ORDERS_SERVICE, page_size: int = PAGE_SIZE) -> DataFrame:
    """``orders`` as the pages of one request day, rows numbered by o_orderkey."""
    return pack_pages(spark, table(spark, sf_dir, "orders"), "o_orderkey", service, rent_dt, page_size)


def fact_api_pages(spark: SparkSession, sf_dir: str, service: str = "rent_daily") -> DataFrame:
    """The API fact rows as pages per request day (yyyyMMdd), numbered by RNUM."""
    day = F.replace(F.col("RENT_DT"), F.lit("-"), F.lit(""))
    return pack_pages(spark, fact_api_rows(spark, sf_dir), F.col("RNUM").cast("long"), service, day)


def station_api_pages(spark: SparkSession, sf_dir: str, service: str = "station_list") -> DataFrame:
    """The station API rows as dimension pages (no date), numbered by station id."""
    return pack_pages(spark, station_api_rows(spark, sf_dir), "stationId", service, None)


def land_pages(spark: SparkSession, pages: DataFrame, name: str) -> DataFrame:
    """Write responses as a Parquet table in the scratch folder and read it back
    with the declared page schema, as the unpacking jobs see landed pages."""
    path = scratch_path(spark, name)
    pages.write.mode("overwrite").parquet(path)
    return spark.read.schema(LANDED_PAGE).parquet(path)


def landed_orders_pages(spark: SparkSession, sf_dir: str, rent_dt: str | None = PAGES_DAY,
                        service: str = ORDERS_SERVICE) -> DataFrame:
    return land_pages(spark, orders_pages(spark, sf_dir, rent_dt=rent_dt, service=service), "landed_pages")


def with_result_page(pages: DataFrame, page_no: int) -> DataFrame:
    """The same pages where page ``page_no`` came back as an end-of-data RESULT."""
    start = (page_no - 1) * PAGE_SIZE + 1
    result = F.lit('{"RESULT":{"CODE":"INFO-200","MESSAGE":"no data"}}')
    return pages.withColumn("body", F.when(F.col("start_index") == start, result).otherwise(F.col("body")))


def orders_row_schema(spark: SparkSession, sf_dir: str):
    return table(spark, sf_dir, "orders").schema
