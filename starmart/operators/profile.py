"""Profiles of a table: shape, gaps and columns without any value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_profile(frame: DataFrame) -> DataFrame:
    """Per column the rows, the missing values and whether no value exists, in one pass.

    A column of an empty table has no value either.
    """
    counts = [F.count(F.col(c)).alias(c) for c in frame.columns]
    totals = frame.agg(F.count(F.lit(1)).alias("_rows"), *counts)
    per_column = totals.unpivot(["_rows"], list(frame.columns), "field", "filled")
    return per_column.select(
        "field",
        F.col("_rows").alias("rows"),
        (F.col("_rows") - F.col("filled")).alias("nulls"),
        (F.col("filled") == 0).alias("all_null"),
    )


def shape(frame: DataFrame) -> DataFrame:
    """Number of rows and of columns."""
    return frame.agg(
        F.count(F.lit(1)).alias("rows"), F.lit(len(frame.columns)).cast("int").alias("columns")
    )
