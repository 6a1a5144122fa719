"""Landing area: one Parquet folder per period, written once from the raw file."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from starmart.schemas import RAW_ARRIVALS
from starmart.sources import paths
from starmart.sources.raw import CORRUPT, file_period, raw_file_name, raw_schema, read_files, read_raw


class SourceMissing(FileNotFoundError):
    """The raw file of the period has not arrived."""


class SourceIncomplete(SourceMissing):
    """A folder of parts has arrived without the mark that it is complete."""


def landed_path(root: str, year: int, month: int) -> str:
    return f"{root}/year={year}/month={month}"


def land(
    spark: SparkSession, incoming: str, root: str, year: int, month: int, force: bool = False
) -> dict[str, int] | None:
    """Write the raw file of a period to the landing area.

    Returns the rows read and the corrupt ones among them, or None if the period had landed
    before. A folder left by a job that did not finish is written again. A delivered folder of
    parts has to be complete (``_SUCCESS``), so that no part arrives unseen later. Corrupt rows
    keep their text, so that a load can count them.
    """
    target = landed_path(root, year, month)
    if not force and paths.is_complete(spark, target):
        return None
    source = f"{incoming}/{raw_file_name(year, month)}"
    if not paths.exists(spark, source):
        raise SourceMissing(source)
    if paths.is_folder(spark, source) and not paths.is_complete(spark, source):
        raise SourceIncomplete(source)
    seen = Observation("landing")
    rows = read_raw(spark, source).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count(CORRUPT).alias("corrupt")
    )
    rows.write.mode("overwrite").parquet(target)
    return dict(seen.get)


def state_of_delivery(spark: SparkSession, incoming: str, year: int, month: int) -> str:
    """``ready``, ``missing``, or ``incomplete`` for a folder of parts without the mark that it is whole."""
    source = f"{incoming}/{raw_file_name(year, month)}"
    if not paths.exists(spark, source):
        return "missing"
    whole = not paths.is_folder(spark, source) or paths.is_complete(spark, source)
    return "ready" if whole else "incomplete"


def land_all(spark: SparkSession, incoming: str, root: str, periods: Iterable[tuple[int, int]]) -> None:
    """Write the raw files of many periods to the landing area in one pass; those landed are left.

    All have to be ready. A period's folder gets its mark after the write, so one that was stopped is
    written again; a period without rows has a folder without files.
    """
    due = [p for p in sorted(set(periods)) if not paths.is_complete(spark, landed_path(root, *p))]
    if not due:
        return
    year, month = file_period()
    rows = read_files(spark, [f"{incoming}/{raw_file_name(y, m)}" for y, m in due])
    rows = rows.withColumns({"year": year, "month": month}).hint("rebalance", "year", "month")
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("year", "month").parquet(root)
    for period in due:
        paths.make_folder(spark, landed_path(root, *period))
        paths.mark_complete(spark, landed_path(root, *period))


def read_landed_periods(
    spark: SparkSession, root: str, periods: Iterable[tuple[int, int]]
) -> DataFrame:
    """The landed rows of some periods with the text of corrupt ones, and ``year`` and ``month``."""
    schema = raw_schema().add("year", IntegerType()).add("month", IntegerType())
    folders = [landed_path(root, *p) for p in sorted(set(periods))]
    return spark.read.schema(schema).option("basePath", root).parquet(*folders)


def read_landed(
    spark: SparkSession, root: str, year: int, month: int, corrupt: bool = False
) -> DataFrame:
    """The landed rows of one period, with the text of corrupt ones if asked for.

    No other folder is listed.
    """
    schema = raw_schema() if corrupt else RAW_ARRIVALS
    return spark.read.schema(schema).parquet(landed_path(root, year, month))
