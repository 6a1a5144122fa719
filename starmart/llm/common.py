"""What the text operators share: word patterns, given tables, shared scratch tables, let-binding."""

from __future__ import annotations

import os
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.session import scratch_path
from starmart.sources import paths

# White space that separates words, as bytes and as a pattern.
SPACES = " \t\n\x0b\x0c\r"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

PYTHON_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Python workers look for this package where the driver has it, too."""
    places = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in places:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*places, ROOT]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, a missing one as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def words(text: Column) -> Column:
    """Words between white space; none for an empty text."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE_PATTERN)
    )


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


# Settings while a table is stored; the first drops the shuffle files of a finished statement.
_WHILE_STORING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Rows of whole texts, vectors and sets are wide: small batches keep Python workers small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared folder and read back: computed once, and safe from lost executors."""
    spark = frame.sparkSession
    path = scratch_path(spark, purpose)
    before = {name: spark.conf.get(name) for name in _WHILE_STORING}
    try:
        for name, value in _WHILE_STORING.items():
            spark.conf.set(name, value)
        frame.write.parquet(path)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    rows = spark.read.schema(frame.schema).parquet(path)
    rows.scratch_path = path
    return rows


def forget(*frames: DataFrame) -> None:
    """Deletes stored tables that nothing reads any more."""
    for frame in frames:
        paths.delete(frame.sparkSession, frame.scratch_path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
