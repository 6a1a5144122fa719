"""Checks of a load as rows ``(check_name, severity, passed, observed, expected)``."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions import key_text
from starmart.operators.filters import outside_period
from starmart.operators.lookup import orphan_keys
from starmart.schemas import FACT_COLUMNS, FACT_REFERENCES, key_of

LOG = logging.getLogger(__name__)
ERROR, WARNING = "error", "warning"
OLDEST_AGE = 120


class QualityError(ValueError):
    """Checks of severity ``error`` that did not pass."""


def _check(name: str, severity: str, passed: Column, observed: Column, expected: str) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"),
        F.lit(severity).alias("severity"),
        passed.alias("passed"),
        observed.cast("bigint").alias("observed"),
        F.lit(expected).alias("expected"),
    )


def _rows(totals: DataFrame, checks: Sequence[Column], *keep: str) -> DataFrame:
    return totals.select(*keep, F.inline(F.array(*checks)))


def literal_rows(spark: SparkSession, rows: Sequence[Mapping[str, Column]]) -> DataFrame:
    """A few rows of literals as a relation of known size; at least one row."""
    values = [F.struct(*(value.alias(name) for name, value in row.items())) for row in rows]
    return spark.range(1).select(F.inline(F.array(*values)))


def single_check(
    spark: SparkSession, name: str, passed: bool, observed: int, expected: str, severity: str = ERROR
) -> DataFrame:
    return spark.range(1).select(
        F.inline(F.array(_check(name, severity, F.lit(passed), F.lit(observed), expected)))
    )


def measured(spark: SparkSession, totals: Mapping[str, int | None], metrics: Sequence[str]) -> DataFrame:
    """Totals observed while the rows passed by, as one row; without rows there may be none."""
    return spark.range(1).select(
        *(F.lit(totals.get(name) or 0).cast("bigint").alias(name) for name in metrics)
    )


def source_metrics(qualifies: Column, corrupt: Column | None = None) -> dict[str, Column]:
    """What the source checks count: rows, qualifying ones without a key, and corrupt ones."""
    without_key = key_text(F.col("cicid")).isNull() & qualifies
    return {
        "rows": F.count(F.lit(1)),
        "keyless": F.count_if(without_key),
        "corrupt": F.lit(0).cast("bigint") if corrupt is None else F.count(corrupt),
    }


def source_report(totals: DataFrame) -> DataFrame:
    rows, keyless, corrupt = F.col("rows"), F.col("keyless"), F.col("corrupt")
    return _rows(
        totals,
        [
            _check("source_has_rows", ERROR, rows > 0, rows, "> 0"),
            _check("arrival_number_present", WARNING, keyless == 0, keyless, "0"),
            _check("corrupt_rows", WARNING, corrupt == 0, corrupt, "0"),
        ],
    )


def source_checks(
    arrivals: DataFrame, qualifies: Column, corrupt: Column | None = None
) -> DataFrame:
    """The source has rows; how many qualifying ones have no key and are left out; corrupt rows."""
    metrics = source_metrics(qualifies, corrupt)
    return source_report(arrivals.agg(*(m.alias(name) for name, m in metrics.items())))


def period_check(
    spark: SparkSession, delivered: set[tuple[int, int]], loaded: set[tuple[int, int]]
) -> DataFrame:
    """Every delivered period brought rows. One of many that did not is not registered."""
    without = len(delivered - loaded)
    return single_check(spark, "every_period_has_rows", without == 0, without, "0", WARNING)


def batch_metrics(year: str = "load_year", month: str = "load_month") -> dict[str, Column]:
    """What the batch checks count. ``year`` and ``month`` name the columns with the period each
    row was loaded for; a row whose period is not known or no calendar month does not match.
    """
    outside = outside_period("Year", "Month", F.col(year), F.col(month))
    wrong_period = F.coalesce(outside | ~F.col(month).between(1, 12), F.lit(True))
    return {
        "rows": F.count(F.lit(1)),
        "wrong_period": F.count_if(wrong_period),
        "null_keys": F.count_if(F.col("CICID").isNull()),
        "odd_ages": F.count_if((F.col("Age") < 0) | (F.col("Age") > OLDEST_AGE)),
        **{f"_{c}": F.count(F.col(c)) for c in FACT_COLUMNS},
    }


def _batch_rows(columns: int) -> list[Column]:
    empty_columns = sum(((F.col(f"_{c}") == 0).cast("int") for c in FACT_COLUMNS), F.lit(0))
    zero = [
        _check(name, severity, F.col(c) == 0, F.col(c), "0")
        for name, severity, c in (
            ("period_matches", ERROR, "wrong_period"),
            ("key_not_null", ERROR, "null_keys"),
            ("age_in_range", WARNING, "odd_ages"),
        )
    ]
    width = F.lit(columns == len(FACT_COLUMNS)), F.lit(columns), str(len(FACT_COLUMNS))
    return [
        _check("batch_not_empty", ERROR, F.col("rows") > 0, F.col("rows"), "> 0"),
        _check("no_empty_column", ERROR, empty_columns == 0, empty_columns, "0"),
        _check("fact_column_count", ERROR, *width),
        *zero,
    ]


def batch_report(totals: DataFrame, columns: int, *keep: str) -> DataFrame:
    """The checks for each row of totals, which keeps its columns ``keep``."""
    return _rows(totals, _batch_rows(columns), *keep)


def period_reports(batch: DataFrame, year: str = "load_year", month: str = "load_month") -> DataFrame:
    """The checks of a batch for each of its periods, in one pass over it."""
    columns = len([c for c in batch.columns if c not in (year, month)])
    totals = batch.groupBy(year, month).agg(*(m.alias(name) for name, m in batch_metrics(year, month).items()))
    return batch_report(totals, columns, year, month)


def batch_checks(batch: DataFrame, year: str = "load_year", month: str = "load_month") -> DataFrame:
    """Checks of new fact rows that need no shuffle, in one pass over them."""
    columns = len([c for c in batch.columns if c not in (year, month)])
    metrics = batch_metrics(year, month)
    return batch_report(batch.agg(*(m.alias(name) for name, m in metrics.items())), columns)


def _key_row() -> Column:
    return _check("key_unique", ERROR, F.col("keys") == 0, F.col("keys"), "0")


def batch_and_key_checks(
    batch: DataFrame, year: str = "load_year", month: str = "load_month", key: str = "CICID"
) -> DataFrame:
    """Both kinds of checks from one reading of the batch: totals per key, then over all keys."""
    metrics = batch_metrics(year, month)
    per_key = batch.groupBy(key).agg(*(m.alias(f"of_{name}") for name, m in metrics.items()))
    totals = per_key.agg(
        *(F.coalesce(F.sum(f"of_{name}"), F.lit(0)).alias(name) for name in metrics),
        F.count_if(F.col("of_rows") > 1).alias("keys"),
    )
    columns = len([c for c in batch.columns if c not in (year, month)])
    return _rows(totals, [*_batch_rows(columns), _key_row()])


def repeated_keys_check(spark: SparkSession, repeated: int) -> DataFrame:
    """The key occurs once, for keys that were counted elsewhere."""
    return _rows(measured(spark, {"keys": repeated}, ["keys"]), [_key_row()])


def key_checks(batch: DataFrame, key: str = "CICID") -> DataFrame:
    """The key occurs once. Only that column is shuffled, counted per task before."""
    repeated = (
        batch.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1).alias("keys"))
    )
    return _rows(repeated, [_key_row()])


def dimension_checks(spark: SparkSession, tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """Every dimension exists (is not None) and has rows; the two failures are told apart.

    The rows of all dimensions are counted by one aggregate, to which each adds a zero.
    """
    found = {name: table for name, table in tables.items() if table is not None}
    missing = [single_check(spark, f"{name}_exists", False, 0, "table") for name in sorted(tables.keys() - found)]
    if not found:
        return union(missing)
    zeros = literal_rows(spark, [{"name": F.lit(name), "one": F.lit(0)} for name in found])
    ones = [t.select(F.lit(name).alias("name"), F.lit(1).alias("one")) for name, t in found.items()]
    counted = union([zeros, *ones]).groupBy("name").agg(F.sum("one").alias("rows"))
    rows = F.col("rows")
    filled = counted.select(
        F.concat("name", F.lit("_has_rows")).alias("check_name"),
        F.lit(ERROR).alias("severity"),
        (rows > 0).alias("passed"),
        rows.alias("observed"),
        F.lit("> 0").alias("expected"),
    )
    return union([filled, *missing])


def fact_orphans(fact: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Fact keys that have no row in their dimension, which the store does not prevent."""
    return orphan_keys(
        fact,
        {column: (tables[name], key_of(name)) for column, name in FACT_REFERENCES.items()},
    )


def growth_check(spark: SparkSession, added: int, new_without_rows: int) -> DataFrame:
    """The fact grew in every period that is new to it; loading a period again may add nothing."""
    severity = ERROR if new_without_rows else WARNING
    passed = added > 0 and not new_without_rows
    return single_check(spark, "fact_grew", passed, added, "> 0 in every new period", severity)


def union(reports: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def failed_by_period(report: DataFrame, year: str = "load_year", month: str = "load_month") -> dict[tuple, str]:
    """Why each period failed, for those that did; a period has some ten checks."""
    failed: dict[tuple, list[str]] = {}
    rows = report.filter(~F.col("passed") & (F.col("severity") == ERROR)).collect()
    for row in sorted(rows, key=lambda r: r.check_name):
        text = f"{row.check_name}: {row.observed}, expected {row.expected}"
        failed.setdefault((row[year], row[month]), []).append(text)
    return {period: "; ".join(texts) for period, texts in failed.items()}


def enforce(report: DataFrame) -> None:
    """Log failed warnings and raise on failed errors. A report has some twenty rows."""
    failed = {ERROR: [], WARNING: []}
    for row in sorted(report.filter(~F.col("passed")).collect(), key=lambda r: r.check_name):
        failed[row.severity].append(f"{row.check_name}: {row.observed}, expected {row.expected}")
    for text in failed[WARNING]:
        LOG.warning(text)
    if failed[ERROR]:
        raise QualityError("; ".join(failed[ERROR]))
