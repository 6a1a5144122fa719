"""The raw monthly file: CSV with a header and a fixed list of columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from starmart.schemas import KEPT_COLUMNS, RAW_ARRIVALS

CORRUPT = "_corrupt_record"

# Name of the raw file of a period, as a format, a glob and a pattern.
RAW_FILE_NAME = "F_{month}_{year}.csv"
RAW_FILE_GLOB = "F_*.csv"
RAW_FILE_PATTERN = r"F_(\d{1,2})_(\d{4})\.csv"


def raw_file_name(year: int, month: int) -> str:
    return RAW_FILE_NAME.format(month=month, year=year)


def raw_file_period(name: str) -> tuple[int, int] | None:
    """Year and month of a raw file's name."""
    match = re.fullmatch(RAW_FILE_PATTERN, name)
    return (int(match[2]), int(match[1])) if match else None


def raw_schema() -> StructType:
    """The raw columns and one that receives the text of a row that does not fit them."""
    return StructType(list(RAW_ARRIVALS.fields)).add(CORRUPT, StringType(), True)


def csv_options() -> dict[str, str]:
    """Columns bind by position, so the header has to name them in that order: a file whose
    header differs fails. A value of the wrong type becomes null and its row is kept.
    """
    return {
        "header": "true",
        "enforceSchema": "false",
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
    }


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(raw_schema()).options(**csv_options()).csv(path)


def read_files(spark: SparkSession, files: list[str]) -> DataFrame:
    """Several raw files, or folders of parts, whose headers are each checked."""
    return spark.read.schema(raw_schema()).options(**csv_options()).csv(files)


def kept(frame: DataFrame) -> DataFrame:
    """The columns the fact is built from."""
    return frame.select(*KEPT_COLUMNS)


def file_period() -> tuple[Column, Column]:
    """Year and month in the name of the raw file, or folder of its parts, a row was read from."""
    path = F.col("_metadata.file_path")
    year = F.regexp_extract(path, RAW_FILE_PATTERN, 2).try_cast("int")
    month = F.regexp_extract(path, RAW_FILE_PATTERN, 1).try_cast("int")
    return year, month
