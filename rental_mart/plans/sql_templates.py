"""Parameterised statements.

What the warehouse templated -- source table, target table and period bounds --
is bound here with IDENTIFIER(:name) and named parameters, never spliced into
SQL text. The cleaning and aggregation are the same column rules and operators
the DataFrame path uses, so there is one definition of the logic.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from rental_mart import functions as fx
from rental_mart.operators import fact as fact_ops

PERIOD_SCAN = ("SELECT * FROM IDENTIFIER(:source_table) "
               "WHERE rent_dt BETWEEN :start_date AND :end_date")

INSERT_BY_NAME = "INSERT INTO IDENTIFIER(:target_table) BY NAME SELECT * FROM IDENTIFIER(:rows_view)"


def period_scan(spark: SparkSession, source_table: str, start, end) -> DataFrame:
    """Rows of a registered ODS table or view whose text date is in the period
    (variant A's filter, pushed to the scan by Catalyst)."""
    s, e = fx.period_bounds(start, end)
    return spark.sql(PERIOD_SCAN, args={
        "source_table": source_table, "start_date": s.isoformat(), "end_date": e.isoformat()})


def fact_dw_sql(spark: SparkSession, source_table: str, start, end) -> DataFrame:
    """The DW rows of a period from a table named at run time."""
    src = period_scan(spark, source_table, start, end)
    return fact_ops.aggregate_fact(src.select(*fact_ops.cleaned_columns(fx.iso_date("rent_dt"))))


def insert_by_name(spark: SparkSession, target_table: str, rows: DataFrame) -> None:
    """C3 for catalog tables: INSERT INTO <target> BY NAME, the target bound as an
    identifier."""
    view = f"_rows_{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(view)
    try:
        spark.sql(INSERT_BY_NAME, args={"target_table": target_table, "rows_view": view})
    finally:
        spark.catalog.dropTempView(view)
