"""Reports on the fact. Each is a lazy DataFrame over the columns it needs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions import as_label, round_half_even
from starmart.operators.lookup import look_up
from starmart.operators.summaries import (
    averages,
    count_by,
    monthly_and_yearly,
    rollup_counts,
    row_count,
)
from starmart.schemas import TABLES


def total_rows(fact: DataFrame) -> DataFrame:
    return row_count(fact)


def by_visa_type(fact: DataFrame) -> DataFrame:
    return count_by(fact, "Visa_Type").orderBy("Visa_Type")


def by_age_group(fact: DataFrame, agegroups: DataFrame) -> DataFrame:
    """Rows per described age group. Counted before the look-up, which then joins few rows."""
    counted = count_by(fact, "Age_Group")
    described = look_up(
        counted, "Age_Group", agegroups, "agegroup_num", {"description": "description"}
    )
    return described.select("Age_Group", "description", "n").orderBy("Age_Group")


def by_gender(fact: DataFrame) -> DataFrame:
    return count_by(fact, "Gender")


def by_month(fact: DataFrame, year: int, text_order: bool = False) -> DataFrame:
    """Rows per month of a year in calendar order, or in the order of the month key as text."""
    counted = count_by(fact.filter(F.col("Year") == year), "Year", "Month", "Monthly_Time")
    order = ["Monthly_Time"] if text_order else ["Year", "Month"]
    return counted.orderBy(*order).select("Monthly_Time", "n")


def by_municipality(fact: DataFrame) -> DataFrame:
    return count_by(fact, "Airport_Municipality")


def average_ages(fact: DataFrame, age_group: int, gender: str) -> DataFrame:
    """Average age of all, of one age group and of one gender, and the same as whole years."""
    cases = {
        "avg_age": None,
        "avg_age_in_group": F.col("Age_Group") == age_group,
        "avg_age_of_gender": F.col("Gender") == gender,
    }
    measured = averages(fact, "Age", cases)
    rounded = {f"{name}_rounded": round_half_even(F.col(name)) for name in cases}
    return measured.withColumns(rounded)


def flights_with_airline(fact: DataFrame, airlines: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` arrivals by number that have a known airline, with its name and country."""
    named = look_up(
        fact.select("CICID", "Monthly_Time", "Flight_Number", "Airline_Code"),
        "Airline_Code",
        airlines,
        "airline_code",
        {"airline_name": "airline_name", "airline_country": "airline_country"},
    ).withColumnRenamed("Airline_Code", "airline_code")
    columns = (
        "CICID",
        "Monthly_Time",
        "Flight_Number",
        "airline_code",
        "airline_name",
        "airline_country",
    )
    return named.select(*columns).orderBy("CICID").limit(n)


def arrivals_with_airport(fact: DataFrame, airports: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` arrivals by number with all columns of their airport but the equal code."""
    extra = [c for c in TABLES["airports"].fieldNames() if c != "airport_code"]
    joined = look_up(fact, "Airport_Code", airports, "airport_code", {c: c for c in extra})
    return joined.orderBy("CICID").limit(n)


# The attributes arrivals are reported by.
REPORT_ATTRIBUTES = (
    "Airport_Municipality",
    "Airport_Code",
    "Visa_Type",
    "Age_Group",
    "Gender",
    "Airline_Code",
    "Flight_Number",
)


def over_time(fact: DataFrame, attribute: str) -> DataFrame:
    """Rows per attribute value by year and by month of the year, with totals."""
    return rollup_counts(fact, attribute, "Year", "Month")


def attributes_over_time(fact: DataFrame) -> DataFrame:
    """Monthly and yearly rows per value of every reported attribute."""
    return monthly_and_yearly(fact, REPORT_ATTRIBUTES, alone=("Flight_Number",))


def rollup_by_time_and_city(fact: DataFrame) -> DataFrame:
    return rollup_counts(fact, "Year", "Month", "Airport_Municipality")


def chart_points(fact: DataFrame) -> DataFrame:
    """``(chart, label, n)`` for the bar charts, from one scan.

    Rows are counted per combination of the charted columns first; the charts then add up
    those few groups.
    """
    charts = ["Visa_Type", "Age_Group", "Gender", "Monthly_Time", "Airport_Municipality"]
    combined = count_by(fact, *charts)
    labels = combined.select("n", *(as_label(F.col(c)).alias(c) for c in charts))
    points = labels.unpivot(["n"], charts, "chart", "label")
    return points.groupBy("chart", "label").agg(F.sum("n").alias("n"))
