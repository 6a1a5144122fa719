"""Joins of a large table with dimensions and dictionaries.

The join strategy is Spark's choice by size unless the dimension comes from ``sized``: beyond the
bounds both sides are shuffled, and AQE splits the partitions of hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 64 * 1024 * 1024

# Fixed value: label of codes that the dictionary does not list.
OTHER_CODES = "All Other Codes"


def fits_broadcast(side: DataFrame) -> bool:
    """Measure a join side: few enough rows and bytes to send to every executor?

    One distributed aggregate; only the two totals come back. A row is charged 16 bytes per
    column on top of its text. Columns whose values may be long in other ways (binary, nested) are
    not measured: a side that has one does not fit.
    """
    if any(kind == "binary" or "<" in kind or kind == "variant" for _, kind in side.dtypes):
        return False
    width = F.lit(16 * len(side.columns)).cast("bigint")
    text = [
        F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0))
        for name, kind in side.dtypes
        if kind == "string"
    ]
    total = side.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(sum(text, width)), F.lit(0)).alias("bytes"),
    ).first()
    return total["rows"] <= BROADCAST_ROWS and total["bytes"] <= BROADCAST_BYTES


def sized(side: DataFrame) -> DataFrame:
    """``side`` with a broadcast hint when measured to fit, else as it is.

    For a side whose size Spark cannot estimate, such as one aggregated from a large table. The
    hint stays through later projections and filters, so one measurement serves several joins.
    """
    return F.broadcast(side) if fits_broadcast(side) else side


def look_up(
    frame: DataFrame,
    field: str,
    dimension: DataFrame,
    key: str,
    columns: dict[str, str],
    how: str = "inner",
) -> DataFrame:
    """Join ``dimension`` on ``field = key`` and add its ``columns`` (name in it: new name).

    The dimension's key has to be unique. It is not added, so no name occurs twice.
    """
    side = dimension.select(
        F.col(key).alias("_key"), *(F.col(c).alias(new) for c, new in columns.items())
    )
    return frame.join(side, frame[field] == side["_key"], how).drop("_key")


def decode(frame: DataFrame, code: Column, codebook: DataFrame, domain: str) -> DataFrame:
    """Add ``label`` and ``code_class`` for a code of one domain of the code dictionary.

    A code not listed gets the label for all other codes and the class ``other``.
    """
    side = codebook.filter(F.col("domain") == domain).select(
        F.col("code").alias("_code"),
        F.col("label").alias("_label"),
        F.col("code_class").alias("_class"),
    )
    return (
        frame.join(side, F.trim(code) == side["_code"], "left")
        .withColumns(
            {
                "label": F.coalesce("_label", F.lit(OTHER_CODES)),
                "code_class": F.coalesce("_class", F.lit("other")),
            }
        )
        .drop("_code", "_label", "_class")
    )


def orphan_keys(frame: DataFrame, dimensions: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Values without a dimension row as ``(field, value, rows)``, in one pass over ``frame``.

    ``dimensions`` gives for each field the dimension and its key. Rows are counted per
    combination and then per value first, so a hot value reaches the anti join as one row.
    """
    fields = list(dimensions)
    combined = frame.groupBy(*fields).agg(F.count(F.lit(1)).alias("n"))
    as_text = combined.select("n", *(F.col(c).cast("string").alias(c) for c in fields))
    values = (
        as_text.unpivot(["n"], fields, "field", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("field", "value")
        .agg(F.sum("n").alias("rows"))
    )
    members = [
        table.select(F.lit(name).alias("field"), F.col(key).cast("string").alias("value"))
        for name, (table, key) in dimensions.items()
    ]
    return values.join(reduce(DataFrame.unionByName, members), ["field", "value"], "left_anti")
