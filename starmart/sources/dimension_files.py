"""Source files of the airport and airline dimensions."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.schemas import AIRLINE_SOURCE, AIRPORT_SOURCE


def read_airports(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; the needed columns are taken by name, all as text."""
    return spark.read.option("header", True).csv(path).select(*AIRPORT_SOURCE.fieldNames())


def read_airlines(spark: SparkSession, path: str, lines: bool | None = None) -> DataFrame:
    """Airlines as JSON: one record a line, which any number of tasks read, or whole documents.

    If ``lines`` is not given, the first line tells: a record that ends on its line is followed by
    others, an opening bracket or brace alone begins a document.
    """
    if lines is None:
        first = spark.read.text(path).filter(F.trim("value") != "").first()
        lines = first is not None and bool(re.fullmatch(r"\s*\{.*\}\s*", first["value"]))
    reader = spark.read.schema(AIRLINE_SOURCE).option("multiLine", not lines).option("mode", "FAILFAST")
    return reader.json(path)
