"""Kept roll-ups: partial aggregates per month of the fact, merged upwards when asked for.

For every month there are rows per reported attribute and value (rows, ages and their sum) and a sketch
of the distinct values per field. Each row names the fact files it was made from, as a digest of their
names; files are never changed in place, so a month whose files are the same is not read again. Years
and totals are sums of months, and unions of their sketches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.operators.filters import in_periods
from starmart.plans.marts import REPORT_ATTRIBUTES
from starmart.plans.quality import literal_rows
from starmart.schemas import FACT_PARTITIONS, FACT_TABLE
from starmart.sources import paths, publish
from starmart.sources.warehouse import Warehouse, by_period

TABLE = "monthlyrollups"
SCHEMA = (
    "kind string, attribute string, value string, n bigint, ages bigint, age_sum bigint, "
    "sketch binary, source string, Year int, Month int"
)
COUNTS, SKETCHES = "counts", "sketches"
MANY_VALUES = ("Flight_Number",)
SKETCHED = ("Flight_Number", "Airline_Code", "Adm_Number")
SKETCH_BITS = 14  # of the number of buckets: a standard error of about 0.8 %


def _counts(fact: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Rows, ages and their sum per month and value of each attribute; combinations are counted first."""
    combined = fact.groupBy(*FACT_PARTITIONS, *attributes).agg(
        F.count(F.lit(1)).alias("n"), F.count("Age").alias("ages"), F.sum("Age").alias("age_sum")
    )
    pairs = [F.struct(F.lit(c).alias("attribute"), F.col(c).cast("string").alias("value")) for c in attributes]
    each = combined.select(*FACT_PARTITIONS, "n", "ages", "age_sum", F.inline(F.array(*pairs)))
    return each.groupBy(*FACT_PARTITIONS, "attribute", "value").agg(
        *(F.sum(c).alias(c) for c in ("n", "ages", "age_sum"))
    )


def partials(fact: DataFrame) -> DataFrame:
    """The rows of the table without ``source``, for all months in ``fact``.

    Attributes with few values are counted together, so groups rather than rows are multiplied; the one
    with many is counted by itself. The sketches of all fields come from one aggregate.
    """
    few = [c for c in REPORT_ATTRIBUTES if c not in MANY_VALUES]
    counts = reduce(DataFrame.unionByName, [_counts(fact, few), *(_counts(fact, [c]) for c in MANY_VALUES)])
    sketched = fact.groupBy(*FACT_PARTITIONS).agg(
        # With a letter before it, since sketches leave out the empty text.
        *(F.hll_sketch_agg(F.concat(F.lit("="), c), F.lit(SKETCH_BITS)).alias(c) for c in SKETCHED)
    )
    pairs = [F.struct(F.lit(c).alias("attribute"), F.col(c).alias("sketch")) for c in SKETCHED]
    sketches = sketched.select(*FACT_PARTITIONS, F.inline(F.array(*pairs)))
    return counts.withColumn("kind", F.lit(COUNTS)).unionByName(
        sketches.withColumn("kind", F.lit(SKETCHES)), allowMissingColumns=True
    )


def _months(warehouse: Warehouse) -> dict[tuple[int, int], str]:
    """For each month of the fact a digest of the names of its files; as many as months."""
    files: dict[tuple[int, int], list[str]] = {}
    for name in paths.files_in(warehouse.spark, warehouse.path(FACT_TABLE)):
        year, month, file = name.split("/")
        files.setdefault((int(year.split("=")[1]), int(month.split("=")[1])), []).append(file)
    return {p: hashlib.sha256("\n".join(names).encode()).hexdigest() for p, names in files.items()}


def read(warehouse: Warehouse) -> DataFrame:
    """The kept rows as they are; ``refresh`` brings them up to date."""
    path = warehouse.path(TABLE)
    if not paths.exists(warehouse.spark, path):
        paths.make_folder(warehouse.spark, path)
    return warehouse.spark.read.schema(SCHEMA).parquet(path)


def stale_months(warehouse: Warehouse) -> tuple[set, set]:
    """Months whose files are not those the kept rows were made from, and months the fact no longer has."""
    now = _months(warehouse)
    kept = read(warehouse).select(*FACT_PARTITIONS, "source").distinct().collect()  # one per month
    made = {(r.Year, r.Month): r.source for r in kept}
    return {p for p, source in now.items() if made.get(p) != source}, made.keys() - now.keys()


def rows_of_months(warehouse: Warehouse, months: set) -> DataFrame:
    """New rows of the table for some months; only these folders of the fact are read."""
    now = _months(warehouse)
    fact = warehouse.read(FACT_TABLE).filter(in_periods(months, *FACT_PARTITIONS))
    sources = [{"Year": F.lit(y), "Month": F.lit(m), "source": F.lit(now[y, m])} for y, m in sorted(months)]
    return partials(fact).join(F.broadcast(literal_rows(warehouse.spark, sources)), list(FACT_PARTITIONS))


def refresh(warehouse: Warehouse) -> set:
    """Recompute the months that changed and put their rows in place of the old ones; returns them."""
    warehouse.finish()
    spark = warehouse.spark
    stale, gone = stale_months(warehouse)
    plan = publish.Plan()
    for year, month in stale | gone:
        folder = f"{warehouse.path(TABLE)}/Year={year}/Month={month}"
        plan.replaced += [f"{folder}/{name}" for name in paths.files_in(spark, folder)]
    ready = warehouse.scratch("rollups")
    if stale:
        rows = rows_of_months(warehouse, stale)
        by_period(rows).write.partitionBy(*FACT_PARTITIONS).parquet(ready)
        plan.staged(ready, warehouse.path(TABLE))
    if stale or gone:
        publish.publish(spark, warehouse.root, plan)
    return stale


def _levels(rows: DataFrame, *keys: str) -> list[tuple[DataFrame, Column]]:
    year, month = FACT_PARTITIONS
    return [(rows.groupBy(*keys, year, month), F.col(month)), (rows.groupBy(*keys, year), F.lit(None).cast("int"))]


def attributes_over_time(warehouse: Warehouse) -> DataFrame:
    """Rows and average age per attribute value by month and by year (``Month`` is null); the fact is not read."""
    kept = read(warehouse).filter(F.col("kind") == COUNTS)
    sums = [F.sum(c).alias(c) for c in ("n", "ages", "age_sum")]
    merged = [
        grouped.agg(*sums).select("attribute", "value", "Year", month.alias("Month"), "n", "ages", "age_sum")
        for grouped, month in _levels(kept, "attribute", "value")
    ]
    return reduce(DataFrame.unionAll, merged)


def distinct_over_time(warehouse: Warehouse) -> DataFrame:
    """Estimated distinct values per sketched field by month and by year; the fact is not read."""
    kept = read(warehouse).filter(F.col("kind") == SKETCHES)
    estimate = F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate")
    merged = [
        grouped.agg(estimate).select(F.col("attribute").alias("field"), "Year", month.alias("Month"), "estimate")
        for grouped, month in _levels(kept, "attribute")
    ]
    return reduce(DataFrame.unionAll, merged)
