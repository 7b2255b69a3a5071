"""Layered rental data marts on Spark: lake pages -> ODS text -> typed DW fact and
station dimension -> summary marts, plus data-quality profiles.

Every operator is a function over DataFrames built from built-in Spark SQL
expressions; writes go through Spark's Parquet writer.
"""

__all__ = ["schemas", "session"]
