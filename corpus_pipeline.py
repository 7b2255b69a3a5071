"""The corpus pipeline: each stage applies one operator to all documents that the one before kept.

All stages but the last return the columns of ``documents``. Rows are written as Parquet between
stages, below the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rental_mart.llm import bpe, jaccard, mixing, secrets, toxicity
from rental_mart.llm.graph import stash
from rental_mart.llm.queries import vocabulary_path
from rental_mart.llm.tables import ship, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose likeliest grade is toxic go; the model is trained on ``labels``."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.grade(docs.select(*COLUMNS), model, keep=COLUMNS).filter(~F.col("toxic")).select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links connect, one row stays: the smallest id's, and of that id's texts in
    the group the one whose name comes first.

    Rows without an id, and texts without words, link with nothing and stay. An id may have texts
    in several groups; each is decided by its own.
    """
    ship(spark)
    rows = docs.select(*COLUMNS)
    linked = jaccard.join(rows, named=True).filter("group is not null")
    first = stash(linked.groupBy("group").agg(F.min(F.struct("doc_id", "text_name")).alias("f")).select("f.*").distinct())
    # The join's own rule for texts that can link: an id, and a word.
    able = F.col("doc_id").isNotNull() & F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # Rows that repeat id and text are one in each task before they are dealt out.
    each = rows.filter(able).groupBy("doc_id", jaccard.text_name(F.col("text")).alias("text_name")).agg(F.min(F.struct("lang", "source", "n_chars", "text")).alias("r"))
    stay = each.join(first, ["doc_id", "text_name"], "left_semi").select("doc_id", "r.*").select(*COLUMNS)
    return stay.unionByName(rows.filter(~able))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, as documents; a text that repeats is a row for each repeat."""
    ship(spark)
    return mixing.mixed_documents(docs.select(*COLUMNS)).select(*COLUMNS)


def scan_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found in a text becomes ``[SECRET]``; all documents stay."""
    ship(spark)
    found = secrets.redact(secrets.scan(docs.select(*COLUMNS)))
    return found.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode to text at all (empty texts give none).

    The ids are written in between, as rows are between stages: a task that encodes and decodes has
    a worker process for each, and a session keeps as many workers as its widest task has had.
    """
    ship(spark)
    path = vocabulary_path()
    ids = stash(bpe.encode(docs, path, keep=("doc_id", "lang", "source")))
    both = ids.withColumn("n_tokens", F.size("ids").cast("long")).withColumn("tokens", F.col("ids"))
    return bpe.decode(both, path, alone=True).select(
        "doc_id", "lang", "source", "n_tokens", F.col("tokens").alias("ids"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("near duplicates", one_of_each),
    ("secrets", scan_secrets),
    ("mixing", mix),
    ("bpe", encode),
]

#: SQL can't train the classifier, scan entropy or encode; tests hold the rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
