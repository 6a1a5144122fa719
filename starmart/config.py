"""Settings of the mart: which arrivals are kept and how gaps are filled."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values.
VISA_CLASSES = ("E1", "E2", "E3")
HOME_REGION = "US-GA"
AIRPORT_TYPES = ("large_airport", "medium_airport")
PLACEHOLDER_AIRLINES = ("Private flight",)
UNKNOWN_GENDER = "U"
UNKNOWN_AIRLINE = "Unknown"
REQUIRED_FIELDS = ("visatype", "i94port", "i94yr", "i94mon", "admnum")


@dataclass(frozen=True)
class MartConfig:
    visa_classes: tuple[str, ...] = VISA_CLASSES
    home_region: str = HOME_REGION
    airport_types: tuple[str, ...] = AIRPORT_TYPES
    placeholder_airlines: tuple[str, ...] = PLACEHOLDER_AIRLINES
    unknown_gender: str = UNKNOWN_GENDER
    unknown_airline: str = UNKNOWN_AIRLINE
    required_fields: tuple[str, ...] = REQUIRED_FIELDS
