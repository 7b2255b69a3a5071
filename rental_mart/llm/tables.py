"""Reads the given tables, and sees to it that the workers can import this package."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Rows in an Arrow batch: texts take some KB each, and a batch is held by the JVM and by the worker.
BATCH_ROWS = 1000

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package to the application's Python files, once for each application, and sets the
    session's Arrow batches to few rows, unless it has a smaller size already."""
    sc = spark.sparkContext
    rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if rows <= 0 or rows > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if sc.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        if package.is_dir():  # not where it was shipped as a zip already
            zipped = shutil.make_archive(f"{tempfile.mkdtemp(prefix='package-')}/{package.name}", "zip", package.parent, package.name)
            sc.addPyFile(zipped)
        _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
