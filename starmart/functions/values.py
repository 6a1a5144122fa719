"""Casts, defaults and text forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _whole(number: Column, kind: str, bits: int) -> Column:
    """Whole part where it fits. Compared first: a failing ``try_cast`` costs an exception a row."""
    limit = float(2 ** (bits - 1))
    fits = (number > -limit - 1) & (number < limit)
    return F.when(fits, number.cast(kind))


def as_integer(number: Column) -> Column:
    """Whole part of a double as int; null where there is none (NaN, out of range)."""
    return _whole(number, "int", 32)


def key_text(number: Column) -> Column:
    """Whole part of a double as text. Goes through bigint: keys outgrow int on large data."""
    return _whole(number, "bigint", 64).cast("string")


def as_label(value: Column) -> Column:
    return value.cast("string")


def fill_unknown(value: Column, default: str) -> Column:
    return F.coalesce(value, F.lit(default))


def is_present(text: Column) -> Column:
    """Neither null nor the empty text."""
    return text.isNotNull() & (text != "")


def round_half_even(number: Column) -> Column:
    """Nearest whole number, a half going to the even one."""
    return F.bround(number).cast("bigint")
