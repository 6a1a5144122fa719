"""Column expressions. All are built-in Spark functions, so they stay in generated code."""

from starmart.functions.calendar import (
    following_period,
    month_key,
    month_name,
    sas_date,
    sas_day,
    short_year,
)
from starmart.functions.traveller import admission_number, age_group, age_in_year
from starmart.functions.values import (
    as_integer,
    as_label,
    fill_unknown,
    is_present,
    key_text,
    round_half_even,
)

__all__ = [
    "admission_number",
    "age_group",
    "age_in_year",
    "as_integer",
    "as_label",
    "fill_unknown",
    "following_period",
    "is_present",
    "key_text",
    "month_key",
    "month_name",
    "round_half_even",
    "sas_date",
    "sas_day",
    "short_year",
]
