"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(
    frame: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Keep the smallest row of each key, comparing ``order`` and then all other columns.

    Nulls sort first and null keys count as equal. Asking for row number 1 lets Spark keep one
    row per key in every task before the shuffle (a window group limit), so a key with many
    copies reaches its window as one row per task.
    """
    rest = [c for c in dict.fromkeys([*order, *frame.columns]) if c not in keys]
    if not rest:
        return frame.select(*keys).distinct()
    ordered = Window.partitionBy(*keys).orderBy(*(F.asc_nulls_first(c) for c in rest))
    numbered = frame.withColumn("_number", F.row_number().over(ordered))
    return numbered.filter(F.col("_number") == 1).drop("_number")
