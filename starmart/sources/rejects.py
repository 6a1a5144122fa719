"""Raw files line by line: good rows to one table, lines that do not fit to another, with file and line.

The text is read once and staged as lines; everything after that reads the stage. A line fits if its file
has the expected header and every value has its column's type. The number of a line is the lines of the
earlier splits of its file and its place in its own split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.schemas import RAW_ARRIVALS
from starmart.sources.raw import CORRUPT, raw_schema

# Fixed value: the first line of a raw file.
HEADER = ",".join(RAW_ARRIVALS.fieldNames())
WRONG_HEADER, WRONG_VALUES = "header", "values"


def staged_lines(spark: SparkSession, files: Sequence[str], folder: str) -> DataFrame:
    """Every line of some files, or folders of parts: ``file, split, place, text``, written and read back.

    ``place`` grows by one from line to line of a split.
    """
    lines = spark.read.text(list(files)).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value").alias("text"),
    )
    lines.write.parquet(folder)
    return spark.read.schema(lines.schema).parquet(folder)


def splits(lines: DataFrame) -> DataFrame:
    """Per split of a file its first place, the lines of the file before it, and if the file's header fits.

    A row per split, of which a file has one per 128 MB or so.
    """
    found = lines.groupBy("file", "split").agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("n"), F.min_by("text", "place").alias("text")
    )
    of_file = Window.partitionBy("file").orderBy("split")
    earlier = of_file.rowsBetween(Window.unboundedPreceding, -1)
    whole = of_file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return found.select(
        "file",
        "split",
        "first",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        (F.first("text").over(whole) == HEADER).alias("fits"),
    )


def sorted_out(lines: DataFrame) -> DataFrame:
    """The data lines: ``file, line, text, reason`` (null for lines that fit) and the raw columns.

    First lines and empty ones are left out; no line of a file without the expected header fits.
    """
    placed = lines.join(splits(lines), ["file", "split"])
    line = F.col("before") + F.col("place") - F.col("first") + 1
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in raw_schema().fields)
    parsed = placed.select(
        "file", "text", "fits", line.cast("bigint").alias("line"), F.from_csv("text", schema, options).alias("row")
    )
    reason = F.when(~F.col("fits"), WRONG_HEADER).when(F.col(f"row.{CORRUPT}").isNotNull(), WRONG_VALUES)
    rows = parsed.filter((F.col("line") > 1) & (F.col("text") != ""))
    return rows.select(
        "file", "line", "text", reason.alias("reason"), *(F.col(f"row.{c}") for c in RAW_ARRIVALS.fieldNames())
    )


def load_lines(spark: SparkSession, files: Sequence[str], good: str, rejected: str, staging: str) -> None:
    """Write the raw rows that fit to one folder and ``file, line, reason, text`` of the others to another."""
    rows = sorted_out(staged_lines(spark, files, staging))
    fitting = rows.filter("reason IS NULL").select(*RAW_ARRIVALS.fieldNames())
    fitting.write.mode("overwrite").parquet(good)
    others = rows.filter("reason IS NOT NULL").select("file", "line", "reason", "text")
    others.write.mode("overwrite").parquet(rejected)
