"""Table layouts: the raw monthly file, the dimension sources and the warehouse tables."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)


def _layout(spec: str) -> StructType:
    """Schema from ``name:type`` pairs, all nullable."""
    types = {"double": DoubleType(), "string": StringType(), "int": IntegerType()}
    pairs = (item.split(":") for item in spec.split())
    return StructType([StructField(name, types[kind], True) for name, kind in pairs])


# The columns of the raw monthly file, in file order.
RAW_ARRIVALS = _layout(
    """
    cicid:double i94yr:double i94mon:double i94cit:double i94res:double i94port:string
    arrdate:double i94mode:double i94addr:string depdate:double i94bir:double i94visa:double
    count:double dtadfile:string visapost:string occup:string entdepa:string entdepd:string
    entdepu:string matflag:string biryear:double dtaddto:string gender:string insnum:string
    airline:string admnum:string fltno:string visatype:string
    """
)

# The raw columns the fact is built from.
KEPT_COLUMNS = (
    "cicid",
    "i94yr",
    "i94mon",
    "i94port",
    "arrdate",
    "biryear",
    "gender",
    "airline",
    "admnum",
    "fltno",
    "visatype",
)

AIRPORT_SOURCE = _layout(
    "name:string type:string municipality:string local_code:string iso_region:string"
)
AIRLINE_SOURCE = _layout("iata:string name:string country:string active:string")

FACT_TABLE = "immigrationfacts"

# Warehouse tables and columns; the first column is the key.
TABLES = {
    "visatypes": _layout("visa_code:string description:string"),
    "genders": _layout("gender_code:string description:string"),
    "agegroups": _layout("agegroup_num:int description:string"),
    "municipalities": _layout("municipality:string"),
    "years": _layout("year:int"),
    "months": _layout("month_num:int month_name:string"),
    "monthlytimes": _layout("monthlytime:string year:int month_num:int"),
    "airports": _layout(
        "airport_code:string airport_type:string name:string municipality:string"
    ),
    "airlines": _layout("airline_code:string airline_name:string airline_country:string"),
    FACT_TABLE: _layout(
        """
        CICID:string Year:int Month:int Day:int Monthly_Time:string Visa_Type:string
        Gender:string Age:int Age_Group:int Airport_Code:string Airport_Municipality:string
        Adm_Number:string Airline_Code:string Flight_Number:string
        """
    ),
}

DIMENSIONS = tuple(name for name in TABLES if name != FACT_TABLE)
PERIOD_DIMENSIONS = ("years", "months", "monthlytimes")
FACT_COLUMNS = tuple(TABLES[FACT_TABLE].fieldNames())
FACT_PARTITIONS = ("Year", "Month")

# The dimension each fact column refers to.
FACT_REFERENCES = {
    "Year": "years",
    "Month": "months",
    "Monthly_Time": "monthlytimes",
    "Visa_Type": "visatypes",
    "Gender": "genders",
    "Age_Group": "agegroups",
    "Airport_Code": "airports",
    "Airport_Municipality": "municipalities",
    "Airline_Code": "airlines",
}


def key_of(table: str) -> str:
    return TABLES[table].fieldNames()[0]
