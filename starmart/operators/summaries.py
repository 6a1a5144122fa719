"""Counts, averages, roll-ups and distinct values.

Grouped results are partial sums on the map side, so a hot group sends one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_count(frame: DataFrame) -> DataFrame:
    return frame.agg(F.count(F.lit(1)).alias("rows"))


def count_by(frame: DataFrame, *groups: str) -> DataFrame:
    return frame.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"))


def averages(frame: DataFrame, value: str, cases: Mapping[str, Column | None]) -> DataFrame:
    """Average of ``value`` in each named case in one pass; the case ``None`` is all rows."""
    measured = F.col(value)
    return frame.agg(
        *(
            F.avg(measured if case is None else F.when(case, measured)).alias(name)
            for name, case in cases.items()
        )
    )


def latest_period(frame: DataFrame, year: str, month: str) -> DataFrame:
    """Greatest year and the greatest month within it, as one row; nulls on empty input."""
    latest = F.max(
        F.struct(F.col(year).cast("int").alias("year"), F.col(month).cast("int").alias("month_num"))
    )
    return frame.agg(latest.alias("latest")).select("latest.*")


def frequencies(frame: DataFrame, field: str) -> DataFrame:
    """Rows per value, missing values left out, most frequent first."""
    counted = count_by(frame.filter(F.col(field).isNotNull()), field)
    return counted.orderBy(F.desc("n"), F.asc(field))


def _stacked(frame: DataFrame, fields: Sequence[str]) -> DataFrame:
    """``(field, value)`` rows with the values as text."""
    as_text = frame.select(*(F.col(c).cast("string").alias(c) for c in fields))
    return as_text.unpivot([], list(fields), "field", "value")


def distinct_values(frame: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Distinct values of several columns in one scan; a missing value is kept."""
    return _stacked(frame, fields).distinct()


def distinct_counts(frame: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Number of distinct values of several columns; a missing value counts as one."""
    return count_by(distinct_values(frame, fields), "field").withColumnRenamed("n", "n_distinct")


def rollup_counts(frame: DataFrame, *levels: str) -> DataFrame:
    """Rows per combination of levels and per total above it; ``level`` is the depth.

    Counted at the finest grain first, so the roll-up multiplies groups rather than rows.
    """
    finest = count_by(frame, *levels)
    return finest.rollup(*levels).agg(
        F.sum("n").alias("n"),
        sum(((F.lit(1) - F.grouping(c)) for c in levels), F.lit(0)).cast("int").alias("level"),
    )


def step_counts(
    frame: DataFrame, steps: Mapping[str, Column], key: str | None = None
) -> DataFrame:
    """Rows left after each step in turn, all in one pass: ``(step_no, step, rows)``.

    With a ``key`` the last step is one row per key. Only rows that passed all others have
    their key shuffled for it.
    """
    passed = F.lit(True)
    measures = {"read": F.count(F.lit(1))}
    for name, condition in steps.items():
        passed = passed & condition
        measures[name] = F.count_if(passed)
    if key:
        measures["one_per_key"] = F.count_distinct(F.when(passed, F.col(key)))
    counted = frame.agg(*(m.alias(name) for name, m in measures.items()))
    rows = F.array(
        *(
            F.struct(
                F.lit(i).alias("step_no"), F.lit(name).alias("step"), F.col(name).alias("rows")
            )
            for i, name in enumerate(measures)
        )
    )
    return counted.select(F.inline(rows))


def monthly_and_yearly(
    frame: DataFrame, attributes: Sequence[str], alone: Sequence[str] = ()
) -> DataFrame:
    """Rows per attribute value by month and by year (``Month`` is null).

    Combinations of the attributes are counted first, so groups rather than rows are multiplied.
    ``alone`` names attributes with many values, each of which is counted by itself.
    """
    together = [c for c in attributes if c not in alone]
    counted = []
    for group in ([together] if together else []) + [[c] for c in attributes if c in alone]:
        groups = count_by(frame, "Year", "Month", *group)
        values = groups.select("Year", "Month", "n", *(F.col(c).cast("string").alias(c) for c in group))
        counted.append(values.unpivot(["Year", "Month", "n"], group, "attribute", "value"))
    by_month = reduce(DataFrame.unionByName, counted)
    year = [F.col(c) for c in ("attribute", "value", "Year")]
    month = F.col("Month")
    return by_month.groupingSets([[*year, month], year], *year, month).agg(F.sum("n").alias("n"))
