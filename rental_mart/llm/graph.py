"""Connected components of an edge table by alternating star contraction, all in Spark."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch(spark: SparkSession) -> None:
    """Sets a checkpoint folder where none is set (tests); a cluster names a shared one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if not sc.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
            import tempfile

            shared = tempfile.mkdtemp(prefix="llm-checkpoint-")
        sc.setCheckpointDir(shared)


def cut(df: DataFrame) -> DataFrame:
    """Writes the rows to the shared checkpoint folder and goes on from there."""
    scratch(df.sparkSession)
    return df.checkpoint(eager=True)


def stash(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Writes the rows as Parquet below the shared checkpoint folder and reads them from there.

    For larger tables than cut() is for: columns are compressed. Like checkpoint files, the folder
    is left to whoever clears the checkpoint folder.
    """
    spark = df.sparkSession
    scratch(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/stash-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _starred(edges: DataFrame, large: bool) -> DataFrame:
    """Links neighbours of each node to the smallest of them: the larger ones, or the others."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if large:
        near = both
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    if large:
        out = near.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = near.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            low.select("a", F.col("m").alias("b"))
        )
    return out.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links -> (node, component), the component being its smallest node.

    Nodes without a link do not appear. Each round contracts stars towards the smallest neighbour
    (large star, then small star), so the number of rounds grows with the logarithm of a
    component's width. No node's links are gathered in one row, and nothing goes to the driver but
    a count and a checksum a round.
    """
    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = mark(now)
    while seen[0]:
        now = cut(_starred(_starred(now, True), False))
        if (then := mark(now)) == seen:
            break
        seen = then
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
