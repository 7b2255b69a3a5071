"""Data-quality profiles (D1-D6). Each is one or two distributed aggregates;
results are small DataFrames, nothing is collected to build them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rental_mart.schemas import FACT_KEYS, FACT_VARCHAR_LIMITS


# ---- D1 ---------------------------------------------------------------------------

def rows_per_day(df: DataFrame, date_col: str = "rent_dt") -> DataFrame:
    """Rows per day, with every day between the first and the last present
    (missing days show 0). Day text may be 'yyyy-MM-dd' or 'yyyyMMdd'; text that
    is no date counts under a NULL day. The spine is one row per calendar day."""
    c = F.col(date_col)
    day = c if isinstance(df.schema[date_col].dataType, T.DateType) else \
        F.try_to_date(F.replace(c.cast("string"), F.lit("-"), F.lit("")), "yyyyMMdd")
    counts = df.groupBy(day.alias("rent_dt")).agg(F.count(F.lit(1)).alias("n_rows"))
    # the bounds read the per-day counts (not the raw rows), so both branches share
    # one aggregation subtree and Spark reuses its exchange: the input is scanned once
    bounds = counts.agg(F.min("rent_dt").alias("lo"), F.max("rent_dt").alias("hi"),
                        F.sum("n_rows").alias("_rows"))
    spine = bounds.where(F.col("_rows") > 0).select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("rent_dt"))
    j = spine.alias("s").join(counts.alias("c"), F.col("s.rent_dt") == F.col("c.rent_dt"), "full_outer")
    return j.select(
        F.coalesce(F.col("s.rent_dt"), F.col("c.rent_dt")).alias("rent_dt"),
        F.coalesce(F.col("c.n_rows"), F.lit(0)).cast("long").alias("n_rows"),
    )


# ---- D2 ---------------------------------------------------------------------------

SCHEMA_LIST = T.StructType([
    T.StructField("position", T.IntegerType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("data_type", T.StringType()),
    T.StructField("nullable", T.BooleanType()),
])


def schema_list(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The schema as rows (metadata only)."""
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, SCHEMA_LIST)


# ---- D3 ---------------------------------------------------------------------------

def null_counts(df: DataFrame) -> DataFrame:
    """D3: one row; each column holds the number of NULLs in that column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


# ---- D4 ---------------------------------------------------------------------------

QUARTILES = (0.25, 0.5, 0.75)
# Split points of a column's value range for the rank search. They only deal the
# distinct values out to tasks; the quartiles are exact wherever they lie.
SPLITS = 64


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def describe(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row per numeric column: count, null_count, mean, std (sample), min,
    q25, q50, q75, max.

    The columns are unpivoted to (column_name, value) and aggregated per column
    with partial aggregation. Quartiles interpolate linearly between the two
    nearest ranks and are exact at every size (see ``_quartiles``)."""
    cols = cols or _numeric(df)
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], cols, "column_name", "v")
    v = F.col("v")
    stats = long.groupBy("column_name").agg(
        F.count(v).alias("count"),
        F.count_if(v.isNull()).alias("null_count"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
    )
    names = [f"q{int(p * 100)}" for p in QUARTILES]
    return stats.join(_quartiles(long), "column_name", "left").select(
        "column_name", "count", "null_count", "mean", "std", "min", *names, "max")


def _quartiles(long: DataFrame) -> DataFrame:
    """Exact quartiles of each column's values, without gathering them.

    Equal values are counted first. The distinct ones are dealt out by value
    ranges (split points from one small sketch per column, a few numbers on the
    driver) and ranked inside a range; the ranges' totals give the rank before
    each. A quartile is the smallest value whose rank passes its position."""
    valued = long.where(F.col("v").isNotNull())
    inner = [i / SPLITS for i in range(1, SPLITS)]
    splits = {r["column_name"]: sorted(set(r["s"])) for r in
              valued.groupBy("column_name").agg(F.percentile_approx("v", inner, 1000).alias("s")).collect()}
    bucket = F.lit(0)
    for name, points in splits.items():
        at = F.array(*[F.lit(float(x)) for x in points])
        bucket = F.when(F.col("column_name") == name, F.size(F.filter(at, lambda x: x < F.col("v")))).otherwise(bucket)
    counted = valued.groupBy("column_name", "v").agg(F.count("*").alias("n")).withColumn("bucket", bucket)
    inside = Window.partitionBy("column_name", "bucket").orderBy("v")
    column = Window.partitionBy("column_name")
    ranges = counted.groupBy("column_name", "bucket").agg(F.sum("n").alias("n")).select(
        "column_name", "bucket",
        (F.sum("n").over(column.orderBy("bucket")) - F.col("n")).alias("before"),
        F.sum("n").over(column).alias("total"))
    ranked = counted.withColumn("upto", F.sum("n").over(inside)).join(ranges, ["column_name", "bucket"])
    upto = F.col("before") + F.col("upto")
    picks, out = [], []
    for p in QUARTILES:
        pos = (F.col("total") - 1) * F.lit(p)
        name = f"q{int(p * 100)}"
        picks += [F.min(F.when(upto > F.floor(pos), F.col("v"))).alias(f"{name}_lo"),
                  F.min(F.when(upto > F.ceil(pos), F.col("v"))).alias(f"{name}_hi"),
                  F.max(pos - F.floor(pos)).alias(f"{name}_part")]
        lo, hi, part = (F.col(f"{name}_{k}") for k in ("lo", "hi", "part"))
        out.append((lo + part * (hi - lo)).alias(name))
    return ranked.groupBy("column_name").agg(*picks).select("column_name", *out)


def describe_text(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """D4 for the other columns (the landed and ODS layers are text): one row per
    column with count, null_count, min and max, compared as text in binary
    order. Partial min/max per task, so no column's values meet in one task."""
    cols = cols or [f.name for f in df.schema.fields if not isinstance(f.dataType, T.NumericType)]
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], cols, "column_name", "v")
    v = F.col("v")
    return long.groupBy("column_name").agg(
        F.count(v).alias("count"),
        F.count_if(v.isNull()).alias("null_count"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
    )


# ---- D5 ---------------------------------------------------------------------------

def constraint_audit(df: DataFrame, keys: tuple[str, ...] = FACT_KEYS,
                     varchar_limits: dict[str, int] = FACT_VARCHAR_LIMITS) -> DataFrame:
    """Violations of the DW fact's declared constraints, one row: NOT NULL on
    each key column, primary-key uniqueness, VARCHAR lengths. All checked columns
    are key columns, so one aggregation per key (partial, then final) followed by
    one over the groups covers them."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    n = F.col("_n")
    aggs = [F.sum(n).alias("n_rows")]
    aggs += [F.sum(F.when(F.col(k).isNull(), n).otherwise(0)).alias(f"null_{k}") for k in keys]
    aggs += [F.count_if(n > 1).alias("dup_pk_groups"),
             F.sum(F.when(n > 1, n).otherwise(0)).alias("dup_pk_rows")]
    aggs += [F.sum(F.when(F.length(k) > lim, n).otherwise(0)).alias(f"long_{k}")
             for k, lim in varchar_limits.items()]
    out = per_key.agg(*aggs)
    return out.select(*[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in out.columns])


# ---- D6 ---------------------------------------------------------------------------

def layout_profile(spark: SparkSession, path: str, schema: T.StructType | None = None,
                   per_file: bool = False, rows_per_file: int | None = None) -> DataFrame:
    """Rows and bytes of each landed file, read from the file's ``_metadata``
    (row-group counts are not exposed by Spark); by default summed per folder
    (files, rows, bytes per day partition). ``rows_per_file`` adds ``n_above``: how many files
    hold more rows than the landing's limit (A6)."""
    r = spark.read.schema(schema) if schema is not None else spark.read
    df = r.parquet(path)
    files = df.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
    ).groupBy("file_path").agg(F.count(F.lit(1)).alias("n_rows"), F.max("file_size").alias("n_bytes"))
    if per_file:
        return files
    folder = F.regexp_replace("file_path", r"/[^/]*$", "")
    return files.groupBy(folder.alias("folder")).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_bytes").alias("n_bytes"),
        *([F.sum((F.col("n_rows") > rows_per_file).cast("long")).alias("n_above")] if rows_per_file else []),
    )
