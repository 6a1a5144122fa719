"""Attributes of a traveller."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Last age of each group but the final, open one.
AGE_GROUP_LIMITS = (25, 35, 45, 59)


def admission_number(text: Column) -> Column:
    """Admission number without its decimals."""
    return F.substring_index(text, ".", 1)


def age_in_year(year: Column, birth_year: Column) -> Column:
    """Age reached in ``year``; null for a birth year too far off to subtract."""
    return F.try_subtract(year, birth_year)


def age_group(age: Column) -> Column:
    """Group number of a whole age: one more than the limits it exceeds; null stays null."""
    exceeded = [(age > limit).cast("int") for limit in AGE_GROUP_LIMITS]
    return reduce(lambda total, flag: total + flag, exceeded, F.lit(1))
