"""Dates and load periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SAS_EPOCH = "1960-01-01"


def sas_date(days: Column) -> Column:
    """Date of a SAS day number. A part of a day belongs to the day it falls in."""
    whole = F.floor(F.nanvl(days, F.lit(None).cast("double"))).try_cast("int")
    return F.date_add(F.lit(SAS_EPOCH).cast("date"), whole)


def sas_day(days: Column) -> Column:
    """Day of month of a SAS day number; null stays null."""
    return F.dayofmonth(sas_date(days))


def month_key(year: Column, month: Column) -> Column:
    """``month_year`` without padding, for example ``1_2016``; null if either part is."""
    return F.concat(month.cast("string"), F.lit("_"), year.cast("string"))


def following_period(year: Column, month: Column) -> Column:
    """Struct ``(year, month_num)`` of the next calendar month."""
    first_day = F.add_months(F.make_date(year, month, F.lit(1)), 1)
    return F.struct(
        F.year(first_day).alias("year"), F.month(first_day).alias("month_num")
    )


def short_year(year: Column) -> Column:
    """Last two digits of a year, as text."""
    return F.right(year.cast("string"), F.lit(2))


def month_name(month: Column) -> Column:
    """Short capitalised month name."""
    return F.date_format(F.make_date(F.lit(2000), month, F.lit(1)), "MMM")
