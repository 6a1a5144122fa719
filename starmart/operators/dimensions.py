"""Cleaned and seeded dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.config import MartConfig
from starmart.functions import is_present, month_key, month_name
from starmart.operators.dedup import first_per_key
from starmart.operators.filters import in_values, not_named
from starmart.schemas import TABLES

# Seed rows.
VISA_TYPES = [
    (
        "E1",
        "Employment First Preference (E1): "
        "Priority Worker and Persons of Extraordinary Ability",
    ),
    (
        "E2",
        "Employment Second Preference (E2): "
        "Professionals Holding Advanced Degrees and Persons of Exceptional Ability",
    ),
    (
        "E3",
        "Employment Third Preference (E3): "
        "Skilled Workers, Professionals, and Unskilled Workers (Other Workers)",
    ),
]
GENDERS = [("M", "Male"), ("F", "Female"), ("X", "X-Gender"), ("U", "Unspecified")]
AGE_GROUPS = [
    (1, "up to 25"),
    (2, "26-35"),
    (3, "36-45"),
    (4, "46-59"),
    (5, "60 and above"),
]
SEEDS = {"visatypes": VISA_TYPES, "genders": GENDERS, "agegroups": AGE_GROUPS}


def seed(spark: SparkSession, table: str) -> DataFrame:
    """A dimension that consists of a few fixed rows, so it is always small enough to broadcast."""
    return F.broadcast(spark.createDataFrame(SEEDS[table], TABLES[table]).coalesce(1))


def clean_airports(source: DataFrame, config: MartConfig) -> DataFrame:
    """Airports of the home region and the wanted sizes that have a code, one row per code."""
    kept = source.filter(
        (F.col("iso_region") == config.home_region)
        & in_values("type", config.airport_types)
        & F.col("local_code").isNotNull()
    ).select(
        F.col("local_code").alias("airport_code"),
        F.col("type").alias("airport_type"),
        "name",
        "municipality",
    )
    return first_per_key(kept, ["airport_code"])


def clean_airlines(source: DataFrame, config: MartConfig) -> DataFrame:
    """Active airlines with a code and a name, without placeholders, one row per code."""
    kept = source.filter(
        (F.col("active") == "Y")
        & is_present(F.col("iata"))
        & is_present(F.col("name"))
        & not_named("name", config.placeholder_airlines)
    ).select(
        F.col("iata").alias("airline_code"),
        F.col("name").alias("airline_name"),
        F.col("country").alias("airline_country"),
    )
    return first_per_key(kept, ["airline_code"])


def municipalities(airports: DataFrame) -> DataFrame:
    """Distinct municipalities; one that is missing cannot be a key."""
    return airports.select("municipality").filter(F.col("municipality").isNotNull()).distinct()


def period_rows(periods: DataFrame) -> dict[str, DataFrame]:
    """Rows of the three period dimensions for frames with ``year`` and ``month_num``."""
    year, month = F.col("year"), F.col("month_num")
    pairs = periods.select(year.cast("int"), month.cast("int")).distinct()
    return {
        "years": pairs.select("year").distinct(),
        "months": pairs.select("month_num", month_name(month).alias("month_name")).distinct(),
        "monthlytimes": pairs.select(
            month_key(year, month).alias("monthlytime"), "year", "month_num"
        ),
    }
