"""Row filters. Each stays a plain predicate, so it reaches the Parquet scan."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def all_present(fields: Iterable[str]) -> Column:
    """Every field is not null. NaN counts as a value."""
    return reduce(lambda a, b: a & b, (F.col(name).isNotNull() for name in fields))


def in_values(field: str, values: Iterable[str]) -> Column:
    return F.col(field).isin(*values)


def in_period(year_field: str, month_field: str, year: Column, month: Column) -> Column:
    return (F.col(year_field) == year) & (F.col(month_field) == month)


def in_periods(periods: Iterable[tuple[int, int]], year_field: str, month_field: str) -> Column:
    """Whether a row is of one of some months; on partition columns it prunes the other folders."""
    months = (in_period(year_field, month_field, F.lit(y), F.lit(m)) for y, m in sorted(periods))
    return reduce(lambda a, b: a | b, months, F.lit(False))


def outside_period(year_field: str, month_field: str, year: Column, month: Column) -> Column:
    """Year or month differ from the expected ones."""
    return (F.col(year_field) != year) | (F.col(month_field) != month)


def missing(frame: DataFrame, field: str) -> DataFrame:
    """Rows to inspect: those without a value in ``field``."""
    return frame.filter(F.col(field).isNull())


def not_named(field: str, names: Iterable[str]) -> Column:
    """Leaves out placeholder records, whatever their letter case."""
    return ~F.lower(F.col(field)).isin(*(name.lower() for name in names))


def in_dimension(frame: DataFrame, field: str, dimension: DataFrame, key: str) -> DataFrame:
    """Rows whose ``field`` occurs among the dimension's keys (semi join)."""
    keys = dimension.select(F.col(key).alias("_member"))
    return frame.join(keys, frame[field] == keys["_member"], "left_semi")
