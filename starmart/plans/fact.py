"""From raw arrivals to fact rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.config import MartConfig
from starmart.functions import (
    admission_number,
    age_group,
    age_in_year,
    as_integer,
    fill_unknown,
    key_text,
    month_key,
    sas_day,
)
from starmart.operators.dedup import first_per_key
from starmart.operators.filters import all_present, in_values
from starmart.operators.lookup import look_up
from starmart.operators.summaries import step_counts
from starmart.schemas import FACT_COLUMNS, KEPT_COLUMNS

LOAD_PERIOD = ("load_year", "load_month")

# Tie-break between arrivals with the same number: the earliest period, then the other columns.
SURVIVOR_ORDER = ("i94yr", "i94mon", "arrdate", *KEPT_COLUMNS)


def cleaning_steps(config: MartConfig) -> dict[str, Column]:
    """The row predicates of the load, in order."""
    return {
        "required_present": all_present(config.required_fields),
        "visa_class": in_values("visatype", config.visa_classes),
    }


def clean_arrivals(
    arrivals: DataFrame, airports: DataFrame, config: MartConfig, within: Sequence[str] = ()
) -> DataFrame:
    """Qualifying arrivals at home airports with the municipality, one row per arrival number.

    ``within`` names columns that keep their arrivals apart: one row per number in each of them.

    Predicates and the airport join come first, so only rows that stay are shuffled to find
    duplicates. The key is the number as the fact stores it, so numbers that are stored alike are
    one; a number that gives no key cannot be one, so such rows are left out.
    """
    rows = arrivals
    for condition in cleaning_steps(config).values():
        rows = rows.filter(condition)
    rows = rows.withColumn("_stored_key", key_text(F.col("cicid"))).filter(F.col("_stored_key").isNotNull())
    city = {"municipality": "Airport_Municipality"}
    at_home = look_up(rows, "i94port", airports, "airport_code", city)
    return first_per_key(at_home, [*within, "_stored_key"], SURVIVOR_ORDER).drop("_stored_key")


def load_step_counts(
    arrivals: DataFrame, airports: DataFrame, config: MartConfig
) -> DataFrame:
    """Rows of a load after each of its steps, to follow where arrivals are left out."""
    marked = look_up(
        arrivals.withColumn("_stored_key", key_text(F.col("cicid"))), "i94port", airports, "airport_code", {"airport_code": "_home"}, "left"
    )
    steps = {**cleaning_steps(config), "home_airport": F.col("_home").isNotNull()}
    return step_counts(marked, steps, "_stored_key")


def derive(cleaned: DataFrame, config: MartConfig) -> DataFrame:
    """Typed and derived columns, named as in the fact; others are kept behind them."""
    year, month = as_integer(F.col("i94yr")), as_integer(F.col("i94mon"))
    age = age_in_year(year, as_integer(F.col("biryear")))
    fact = {
        "CICID": key_text(F.col("cicid")),
        "Year": year,
        "Month": month,
        "Day": sas_day(F.col("arrdate")),
        "Monthly_Time": month_key(year, month),
        "Visa_Type": F.col("visatype"),
        "Gender": fill_unknown(F.col("gender"), config.unknown_gender),
        "Age": age,
        "Age_Group": age_group(age),
        "Airport_Code": F.col("i94port"),
        "Airport_Municipality": F.col("Airport_Municipality"),
        "Adm_Number": admission_number(F.col("admnum")),
        "Airline_Code": fill_unknown(F.col("airline"), config.unknown_airline),
        "Flight_Number": F.col("fltno"),
    }
    others = [c for c in cleaned.columns if c not in KEPT_COLUMNS and c not in fact]
    return cleaned.select(*(value.alias(name) for name, value in fact.items()), *others)


def fact_rows(
    arrivals: DataFrame, airports: DataFrame, config: MartConfig, within: Sequence[str] = ()
) -> DataFrame:
    """The fact's 14 columns, followed by columns of the input that are not raw ones."""
    derived = derive(clean_arrivals(arrivals, airports, config, within), config)
    return derived.select(*FACT_COLUMNS, *(c for c in derived.columns if c not in FACT_COLUMNS))


def with_airline(fact: DataFrame, airlines: DataFrame) -> DataFrame:
    """The fact with name and country of the airline; an unknown airline keeps its rows."""
    return look_up(
        fact,
        "Airline_Code",
        airlines,
        "airline_code",
        {"airline_name": "airline_name", "airline_country": "airline_country"},
        "left",
    )
