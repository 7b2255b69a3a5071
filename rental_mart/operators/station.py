"""Station dimension: cleaning (B11), SCD1 upsert (C6), soft delete (C7), counts.

Matching is an equi-join on the station code. NULL codes never match, so
NULL-keyed rows are split off or spread before any join: they would otherwise all
hash to one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rental_mart import functions as fx
from rental_mart.schemas import DW_STATION, STATION_ATTRS, names


def clean_station(ods: DataFrame) -> DataFrame:
    """B11 (with B8-B10): the typed attributes of the 7 raw station columns."""
    return ods.select(
        F.col("stationid").alias("station_cd"),
        fx.station_number("stationname").alias("station_no"),
        fx.station_name("stationname").alias("station_nm"),
        fx.blank_decimal("stationlatitude", 10, 8).alias("station_lat"),
        fx.blank_decimal("stationlongitude", 11, 8).alias("station_lon"),
        fx.blank_int("racktotcnt").alias("rack_tot_cnt"),
        fx.blank_int("parkingbiketotcnt").alias("parking_bike_tot_cnt"),
        fx.blank_int("shared").alias("shared"),
    )


def _source_rows(source_clean: DataFrame) -> DataFrame:
    """The source's distinct rows with the number of times each occurs (``_copies``).

    Equal rows are counted by input task, so a count never exceeds what one task read
    and can be expanded again in one task."""
    return (source_clean.select("station_cd", *STATION_ATTRS)
            .groupBy("station_cd", *STATION_ATTRS, F.spark_partition_id().alias("_task"))
            .agg(F.count(F.lit(1)).alias("_copies")))


def _source_codes(rows: DataFrame) -> DataFrame:
    """One row per source code, the NULL code included: the number of source rows
    (0 for NULL codes, which match nothing) and, for a unique code, its attributes."""
    times = F.when(F.col("station_cd").isNotNull(), F.col("_copies")).otherwise(F.lit(0))
    return rows.groupBy("station_cd").agg(
        F.sum(times).alias("_n"), F.max(F.struct(*STATION_ATTRS)).alias("_attrs"))


def _inserts_beside_the_join(rows: DataFrame, codes: DataFrame) -> DataFrame:
    """Source rows that no target row can match: NULL codes and codes that occur more
    than once (those raise where the target has them). Rows with a NULL code are spread
    by their attributes instead of meeting in one task. The keys are made non-NULL first:
    an IS NOT NULL filter inferred from the join would reach the source's scan and part
    it from the other branch's, which reads the same aggregate."""
    salt = F.when(F.col("station_cd").isNull(), F.xxhash64(*STATION_ATTRS).bitwiseOR(F.lit(1))).otherwise(F.lit(0))
    r = rows.withColumn("_code", F.coalesce("station_cd", F.lit(""))).withColumn("_salt", salt)
    repeated = codes.where(F.col("_n") > 1).select(
        F.coalesce("station_cd", F.lit("")).alias("_repeated"), F.lit(0).cast("long").alias("_no_salt"))
    j = r.join(repeated, (F.col("_code") == F.col("_repeated")) & (F.col("_salt") == F.col("_no_salt")), "left")
    return (j.where(F.col("station_cd").isNull() | F.col("_repeated").isNotNull())
            .select("station_cd", *STATION_ATTRS, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_copy"))
            .drop("_copy"))


def merge_station(target: DataFrame, source_clean: DataFrame, load_ts=None,
                  delete_missing: bool = False) -> DataFrame:
    """C6, and with ``delete_missing`` C7 after it, in one join on the station code.

    matched     -> attributes from source, last_updated = load_ts,
                   is_deleted = FALSE, created_at kept;
    source only -> inserted, created_at = last_updated = load_ts, not deleted;
    target only -> unchanged, or with ``delete_missing`` marked as deleted under the
                   NOT IN rules of ``soft_delete_missing``.

    The source is read once, into one aggregate per code that the join, the inserts
    beside it and the NOT IN flags share; a code holding a large share of the source is
    combined map-side. A source code that occurs more than once and matches a target row
    would be updated twice by a MERGE: the plan raises when it is run."""
    ts = fx.timestamp_literal(load_ts)
    rows = _source_rows(source_clean)
    codes = _source_codes(rows)
    t = target.select(*names(DW_STATION))
    key_t, key_s, n = F.col("t.station_cd"), F.col("s.station_cd"), F.col("s._n")
    twice = F.raise_error(F.concat(
        F.lit("MERGE would update a target row twice; duplicate source station code: "), key_s)).cast("boolean")
    joined = (t.where(F.col("station_cd").isNotNull()).alias("t")
              .join(codes.alias("s"), key_t == key_s, "full_outer")
              .where(F.when(key_t.isNotNull() & (n > 1), twice).otherwise(key_t.isNotNull() | (n == 1))))
    in_src: Column = key_s.isNotNull()
    null_t = t.where(F.col("station_cd").isNull()).alias("t")
    gone = gone_null = F.lit(False)
    if delete_missing:
        # the attributes are read along so that the flags use the same aggregate
        source = codes.agg(F.struct(F.bool_or(F.col("station_cd").isNull()).alias("has_null"),
                                    F.count(F.lit(1)).alias("codes"), F.sum("_n"), F.max("_attrs")).alias("f")).scalar()
        active = F.coalesce(F.col("t.is_deleted") == F.lit(False), F.lit(False))
        gone = active & ~F.coalesce(source["has_null"], F.lit(False))
        gone_null = active & (source["codes"] == 0)
    merged = joined.select(
        F.coalesce(key_s, key_t).alias("station_cd"),
        *[F.when(in_src, F.col(f"s._attrs.{a}")).otherwise(F.col(f"t.{a}")).alias(a) for a in STATION_ATTRS],
        F.when(key_t.isNotNull(), F.col("t.created_at")).otherwise(ts).alias("created_at"),
        F.when(in_src | gone, ts).otherwise(F.col("t.last_updated")).alias("last_updated"),
        F.when(in_src, F.lit(False)).when(gone, F.lit(True)).otherwise(F.col("t.is_deleted")).alias("is_deleted"),
    )
    kept = null_t.select(
        *[F.col(f"t.{c}") for c in names(DW_STATION) if c not in ("last_updated", "is_deleted")],
        F.when(gone_null, ts).otherwise(F.col("t.last_updated")).alias("last_updated"),
        F.when(gone_null, F.lit(True)).otherwise(F.col("t.is_deleted")).alias("is_deleted"))
    inserted = _inserts_beside_the_join(rows, codes).select(
        "station_cd", *STATION_ATTRS,
        ts.alias("created_at"), ts.alias("last_updated"), F.lit(False).alias("is_deleted"))
    return merged.unionByName(kept).unionByName(inserted)


def upsert_station(target: DataFrame, source_clean: DataFrame, load_ts=None) -> DataFrame:
    """MERGE ON target.station_cd = source.station_cd (see ``merge_station``)."""
    return merge_station(target, source_clean, load_ts)


def soft_delete_missing(target: DataFrame, source_clean: DataFrame, load_ts=None) -> DataFrame:
    """UPDATE target SET is_deleted = TRUE, last_updated = load_ts
    WHERE is_deleted = FALSE AND station_cd NOT IN (SELECT station_cd FROM source).

    NOT IN semantics: one NULL code in the source disables the delete; an empty
    source deletes every active row, NULL codes included. Written as a left join
    on distinct source codes plus two scalar flags instead of Spark's null-aware
    anti join, which needs the whole source broadcast."""
    ts = fx.timestamp_literal(load_ts)
    # the distinct source codes, NULL included, feed the join and both flags, so
    # Spark can reuse one aggregation (partial aggregation leaves one NULL row per
    # task, so NULL codes cannot pile up either)
    codes = source_clean.select("station_cd").distinct()
    has_null = codes.where(F.col("station_cd").isNull()).exists()
    non_empty = codes.exists()
    keys = codes.where(F.col("station_cd").isNotNull()).select(
        F.col("station_cd").alias("_src_cd"), F.lit(True).alias("_in_src"))

    t = target.select(*names(DW_STATION))
    t_nn = t.where(F.col("station_cd").isNotNull()).join(
        keys, F.col("station_cd") == F.col("_src_cd"), "left")
    active = F.col("is_deleted") == F.lit(False)
    hit_nn = F.coalesce(active, F.lit(False)) & ~has_null & F.col("_in_src").isNull()
    t_null = t.where(F.col("station_cd").isNull())
    hit_null = F.coalesce(active, F.lit(False)) & ~non_empty

    def apply(df: DataFrame, hit: Column) -> DataFrame:
        return df.select(
            *[F.col(c) for c in names(DW_STATION) if c not in ("last_updated", "is_deleted")],
            F.when(hit, ts).otherwise(F.col("last_updated")).alias("last_updated"),
            F.when(hit, F.lit(True)).otherwise(F.col("is_deleted")).alias("is_deleted"),
        )

    return apply(t_nn, hit_nn).unionByName(apply(t_null, hit_null))


def active_only(dim: DataFrame) -> DataFrame:
    """``is_deleted = FALSE`` (NULL is not active)."""
    return dim.where(F.col("is_deleted") == F.lit(False))


def active_count(dim: DataFrame) -> DataFrame:
    """COUNT(*) WHERE is_deleted = FALSE."""
    return active_only(dim).agg(F.count(F.lit(1)).alias("n_active"))
