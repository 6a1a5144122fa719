"""Hand-made rows for the tests."""

from starmart.schemas import KEPT_COLUMNS, RAW_ARRIVALS

HOME = [("ATL", "large_airport", "Big", "Atlanta"), ("SAV", "medium_airport", "Sea", "Savannah")]
AIRLINES = [("DL", "Delta", "United States")]

# cicid, i94yr, i94mon, i94port, arrdate, biryear, gender, airline, admnum, fltno, visatype
ARRIVALS = [
    (1.0, 2016.0, 1.0, "ATL", 20454.0, 1991.0, "F", "DL", "92478490733.0", "00123", "E1"),
    (2.0, 2016.0, 1.0, "SAV", 20484.0, 1990.0, None, None, "123", "7", "E2"),
    (3.0, 2016.0, 1.0, "ATL", 20454.0, 1981.0, "M", "ZZ", ".5", "1", "E3"),
    (4.0, 2016.0, 1.0, "ATL", 20454.0, 1980.0, "M", "DL", "4.0", "1", "E3"),
    (5.0, 2016.0, 1.0, "ATL", 20454.0, 1971.0, "M", "DL", "5.0", "1", "E3"),
    (6.0, 2016.0, 1.0, "ATL", 20454.0, 1970.0, "M", "DL", "6.0", "1", "E3"),
    (7.0, 2016.0, 1.0, "ATL", 20454.0, 1957.0, "M", "DL", "7.0", "1", "E3"),
    (8.0, 2016.0, 1.0, "ATL", 20454.0, 1956.0, "X", "DL", "8.0", "1", "E3"),
    (1.0, 2016.0, 1.0, "ATL", 20455.0, 1991.0, "F", "DL", "1.0", "1", "E1"),
    (9.0, 2016.0, 1.0, "ATL", 20454.0, 1990.0, "F", "DL", None, "1", "E1"),
    (10.0, 2016.0, 1.0, "ATL", 20454.0, 1990.0, "F", "DL", "1.0", "1", "B2"),
    (11.0, 2016.0, 1.0, "MIA", 20454.0, 1990.0, "F", "DL", "1.0", "1", "E1"),
    (12.0, 2016.0, 1.0, "ATL", None, None, "F", "DL", "1.0", "1", "E1"),
]
OTHER_PERIOD = (13.0, 2016.0, 2.0, "ATL", 20485.0, 1990.0, "F", "DL", "1.0", "1", "E1")
WITHOUT_KEY = (None, 2016.0, 1.0, "ATL", 20454.0, 1990.0, "F", "DL", "1.0", "1", "E1")
KEPT_IDS = ["1", "12", "2", "3", "4", "5", "6", "7", "8"]

HEADER = ",".join(RAW_ARRIVALS.fieldNames())

AIRPORT_FILE = """\
ident,type,name,iso_region,municipality,local_code
K1,large_airport,Big,US-GA,Atlanta,ATL
K2,medium_airport,"Sea, by the",US-GA,Savannah,SAV
K3,small_airport,Tiny,US-GA,Macon,TNY
K4,large_airport,Away,US-FL,Miami,MIA
K5,medium_airport,No code,US-GA,Augusta,
K6,large_airport,Copy,US-GA,Atlanta,ATL
"""
AIRLINE_FILE = """\
[
 {"id": "1", "name": "Private flight", "iata": "-", "country": "", "active": "Y"},
 {"id": "2", "name": "Delta", "iata": "DL", "country": "United States", "active": "Y"},
 {"id": "3", "name": "Gone Air", "iata": "GA", "country": "Nowhere", "active": "N"},
 {"id": "4", "name": "No code", "iata": null, "country": "Nowhere", "active": "Y"},
 {"id": "5", "name": "Empty code", "iata": "", "country": "Nowhere", "active": "Y"},
 {"id": "6", "name": "", "iata": "XX", "country": "Nowhere", "active": "Y"},
 {"id": "7", "name": "Zeta copy", "iata": "DL", "country": "Nowhere", "active": "Y"}
]
"""


def schema_of_kept():
    return RAW_ARRIVALS.__class__([RAW_ARRIVALS[name] for name in KEPT_COLUMNS])


def csv_line(row) -> str:
    """A raw file line with the columns the fact does not use left empty."""
    values = dict(zip(KEPT_COLUMNS, (row[KEPT_ORDER.index(c)] for c in KEPT_COLUMNS), strict=True))
    return ",".join(
        "" if values.get(name) is None else str(values[name]) for name in RAW_ARRIVALS.fieldNames()
    )


KEPT_ORDER = list(KEPT_COLUMNS)


def write_raw(path, rows, header=HEADER) -> str:
    path.write_text("\n".join([header, *(csv_line(r) for r in rows)]) + "\n")
    return str(path)
