"""Compaction: the small files of many loads become few, month by month.

A month is rewritten when it has more files than its bytes need. The new files are staged and replace
the old ones by a written plan, so a stopped job leaves the old files or is finished later, and rows are
neither lost nor doubled. Months that need nothing are not read.
"""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import functions as F

from starmart.operators.filters import in_periods
from starmart.plans.quality import literal_rows
from starmart.schemas import FACT_COLUMNS, FACT_PARTITIONS, FACT_TABLE, key_of
from starmart.sources import paths, publish
from starmart.sources.warehouse import Warehouse

FILE_BYTES = 256 * 1024 * 1024


def crowded_months(warehouse: Warehouse, file_bytes: int) -> dict[tuple[int, int], int]:
    """Months with more files than ``file_bytes`` a file need, and how many they need."""
    sizes: dict[tuple[int, int], list[int]] = {}
    for name, size in paths.sizes_in(warehouse.spark, warehouse.path(FACT_TABLE)).items():
        year, month, _ = name.split("/")
        sizes.setdefault((int(year.split("=")[1]), int(month.split("=")[1])), []).append(size)
    needed = {p: max(1, math.ceil(sum(own) / file_bytes)) for p, own in sizes.items()}
    return {p: n for p, n in needed.items() if len(sizes[p]) > n}


def compact(warehouse: Warehouse, file_bytes: int = FILE_BYTES) -> set[tuple[int, int]]:
    """Rewrite crowded months to at most the files they need; returns the months.

    A month's rows are dealt to its files by key, so each file is written by one task and a large month
    by several.
    """
    warehouse.finish()
    months = crowded_months(warehouse, file_bytes)
    if not months:
        return set()
    spark, ready = warehouse.spark, warehouse.scratch("compacted")
    plan = publish.Plan()
    for year, month in months:
        folder = warehouse.period_path(year, month)
        plan.replaced += [f"{folder}/{name}" for name in paths.files_in(spark, folder)]
    of_year, of_month = FACT_PARTITIONS
    firsts = accumulate(months.values(), initial=0)
    wanted = [
        {of_year: F.lit(y), of_month: F.lit(m), "_files": F.lit(n), "_first": F.lit(first)}
        for ((y, m), n), first in zip(months.items(), firsts, strict=False)
    ]
    rows = warehouse.read(FACT_TABLE).filter(in_periods(months, of_year, of_month))
    rows = rows.join(F.broadcast(literal_rows(spark, wanted)), [of_year, of_month])
    number = F.col("_first") + F.pmod(F.xxhash64(key_of(FACT_TABLE)), F.col("_files"))
    dealt = rows.repartitionById(sum(months.values()), number.cast("int")).select(*FACT_COLUMNS)
    dealt.write.partitionBy(*FACT_PARTITIONS).parquet(ready)
    plan.staged(ready, warehouse.path(FACT_TABLE))
    publish.publish(spark, warehouse.root, plan)
    return set(months)
