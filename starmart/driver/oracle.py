"""The registered queries as SQL over the given tables."""

from __future__ import annotations

from starmart.driver.adapters import REPORT_YEAR
from starmart.driver.queries import BAD_MONTH, PROFILED, SECOND_DELIVERY_YEAR
from starmart.plans.marts import REPORT_ATTRIBUTES
from starmart.schemas import KEPT_COLUMNS, RAW_ARRIVALS

ARR = """
    SELECT CAST(o_orderkey AS DOUBLE) AS cicid,
           CAST(year(o_orderdate) AS DOUBLE) AS i94yr,
           CAST(month(o_orderdate) AS DOUBLE) AS i94mon,
           n_name AS i94port,
           CAST(CAST(o_orderdate AS DATE) - DATE '1960-01-01' AS DOUBLE) AS arrdate,
           CAST(year(o_orderdate) - (18 + o_custkey % 60) AS DOUBLE) AS biryear,
           nullif(o_orderstatus, 'P') AS gender,
           nullif(c_mktsegment, 'BUILDING') AS airline,
           CAST(o_totalprice AS VARCHAR) AS admnum,
           CAST(o_custkey % 1000 AS VARCHAR) AS fltno,
           o_orderpriority AS visatype
    FROM orders
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
"""

AIRPORTS = """
    SELECT n_name AS airport_code, 'large_airport' AS airport_type,
           'Port of ' || n_name AS name, n_name AS municipality
    FROM nation WHERE n_regionkey = 1
"""

AIRLINES = """
    SELECT DISTINCT c_mktsegment AS airline_code, 'Air ' || c_mktsegment AS airline_name,
           'Earth' AS airline_country
    FROM customer WHERE c_mktsegment <> 'MACHINERY'
"""

LINES = """
    SELECT CASE WHEN l_linenumber <> 7 THEN CAST(l_orderkey AS DOUBLE) END AS cicid,
           CAST(year(l_shipdate) AS DOUBLE) AS i94yr,
           CAST(month(l_shipdate) AS DOUBLE) AS i94mon,
           n_name AS i94port,
           CASE WHEN l_linenumber <> 6
               THEN CAST(CAST(l_shipdate AS DATE) - DATE '1960-01-01' AS DOUBLE) END AS arrdate,
           CASE WHEN l_linenumber <> 6 THEN CAST(year(l_shipdate) - l_partkey % 90 AS DOUBLE) END AS biryear,
           nullif(l_returnflag, 'N') AS gender,
           l_linestatus AS airline,
           CAST(l_partkey AS VARCHAR) AS admnum,
           CAST(l_suppkey AS VARCHAR) AS fltno,
           CASE WHEN l_linenumber % 2 = 1 THEN '1-URGENT' ELSE '2-HIGH' END AS visatype
    FROM lineitem
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey
"""


def _fact(arrivals: str) -> str:
    return f"""
    WITH arr AS ({arrivals}),
    airports AS ({AIRPORTS}),
    kept AS (
        SELECT arr.*, row_number() OVER (
            PARTITION BY cicid
            ORDER BY i94yr NULLS FIRST, i94mon NULLS FIRST, arrdate NULLS FIRST,
                     i94port NULLS FIRST, biryear NULLS FIRST, gender NULLS FIRST,
                     airline NULLS FIRST, admnum NULLS FIRST, fltno NULLS FIRST,
                     visatype NULLS FIRST) AS rn
        FROM arr
        WHERE visatype IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AND cicid IS NOT NULL
          AND i94port IS NOT NULL AND i94yr IS NOT NULL AND i94mon IS NOT NULL
          AND admnum IS NOT NULL
          AND i94port IN (SELECT airport_code FROM airports)
    ),
    typed AS (
        SELECT *, CAST(trunc(i94yr) AS INTEGER) AS y, CAST(trunc(i94mon) AS INTEGER) AS m,
               CAST(trunc(i94yr) AS INTEGER) - CAST(trunc(biryear) AS INTEGER) AS a
        FROM kept WHERE rn = 1
    )
    SELECT CAST(CAST(trunc(cicid) AS BIGINT) AS VARCHAR) AS CICID, y AS Year, m AS Month,
           CAST(day(DATE '1960-01-01' + CAST(floor(arrdate) AS INTEGER)) AS INTEGER) AS Day,
           CAST(m AS VARCHAR) || '_' || CAST(y AS VARCHAR) AS Monthly_Time,
           visatype AS Visa_Type, coalesce(gender, 'U') AS Gender, a AS Age,
           CAST(CASE WHEN a <= 25 THEN 1 WHEN a <= 35 THEN 2 WHEN a <= 45 THEN 3
                     WHEN a <= 59 THEN 4 WHEN a >= 60 THEN 5 END AS INTEGER) AS Age_Group,
           i94port AS Airport_Code, municipality AS Airport_Municipality,
           split_part(admnum, '.', 1) AS Adm_Number, coalesce(airline, 'Unknown') AS Airline_Code,
           fltno AS Flight_Number
    FROM typed JOIN airports ON i94port = airport_code
"""


FACT = _fact(ARR)
WITH_ARR = f"WITH arr AS ({ARR})"
WITH_FACT = f"WITH fact AS ({FACT})"
WITH_MART = f"WITH fact AS ({FACT}), airports AS ({AIRPORTS}), airlines AS ({AIRLINES})"

AIRPORT_SOURCE = """
    SELECT s_name AS name,
           CASE s_suppkey % 3 WHEN 0 THEN 'large_airport' WHEN 1 THEN 'medium_airport'
                              ELSE 'small_airport' END AS type,
           n_name AS municipality,
           CASE WHEN s_suppkey % 7 <> 0 THEN 'P' || CAST(s_suppkey // 2 AS VARCHAR) END AS local_code,
           'R-' || CAST(n_regionkey AS VARCHAR) AS iso_region
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
"""

CLEAN_AIRPORTS = f"""
    SELECT airport_code, airport_type, name, municipality FROM (
        SELECT local_code AS airport_code, type AS airport_type, name, municipality,
               row_number() OVER (PARTITION BY local_code
                                  ORDER BY type NULLS FIRST, name NULLS FIRST,
                                           municipality NULLS FIRST) AS rn
        FROM ({AIRPORT_SOURCE})
        WHERE iso_region = 'R-1' AND type IN ('large_airport', 'medium_airport')
          AND local_code IS NOT NULL
    ) WHERE rn = 1
"""

CLEAN_AIRLINES = """
    SELECT airline_code, airline_name, airline_country FROM (
        SELECT iata AS airline_code, name AS airline_name, country AS airline_country,
               row_number() OVER (PARTITION BY iata
                                  ORDER BY name NULLS FIRST, country NULLS FIRST) AS rn
        FROM (
            SELECT CASE WHEN c_custkey % 10 = 9 THEN ''
                        WHEN c_custkey % 11 <> 0 THEN 'A' || CAST(c_custkey // 2 AS VARCHAR)
                   END AS iata,
                   c_name AS name, n_name AS country,
                   CASE WHEN c_acctbal > 0 THEN 'Y' ELSE 'N' END AS active
            FROM customer JOIN nation ON c_nationkey = n_nationkey
        )
        WHERE active = 'Y' AND iata IS NOT NULL AND iata <> '' AND name IS NOT NULL AND name <> ''
          AND lower(name) <> 'customer#000000001'
    ) WHERE rn = 1
"""

PERIODS = """
    SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year,
                    CAST(month(o_orderdate) AS INTEGER) AS month_num
    FROM orders
"""

FIRST_HALF = "ts < TIMESTAMP '2024-01-16 00:00:00'"


def _check(name: str, severity: str, passed: str, observed: str, expected: str) -> str:
    return (
        f"SELECT '{name}' AS check_name, '{severity}' AS severity, {passed} AS passed, "
        f"CAST({observed} AS BIGINT) AS observed, '{expected}' AS expected"
    )


def _rollup(levels: list[str]) -> str:
    columns = ", ".join(levels)
    depth = " + ".join(f"(1 - grouping({c}))" for c in levels)
    return f"""{WITH_FACT}
        SELECT {columns}, count(*) AS n, CAST({depth} AS INTEGER) AS level
        FROM fact GROUP BY ROLLUP ({columns})"""


def _charts() -> str:
    charts = ["Visa_Type", "Age_Group", "Gender", "Monthly_Time", "Airport_Municipality"]
    parts = (
        f"SELECT '{c}' AS chart, CAST({c} AS VARCHAR) AS label, count(*) AS n FROM fact GROUP BY {c}"
        for c in charts
    )
    return f"{WITH_FACT} {' UNION ALL '.join(parts)}"


def _attributes() -> str:
    parts = (
        f"SELECT '{c}' AS attribute, CAST({c} AS VARCHAR) AS value, Year, Month, count(*) AS n "
        f"FROM fact GROUP BY GROUPING SETS (({c}, Year, Month), ({c}, Year))"
        for c in REPORT_ATTRIBUTES
    )
    return f"{WITH_FACT} {' UNION ALL '.join(parts)}"


def _kept_rollups() -> str:
    parts = (
        f"SELECT '{c}' AS attribute, CAST({c} AS VARCHAR) AS value, Year, Month, count(*) AS n, "
        f"count(Age) AS ages, CAST(sum(Age) AS BIGINT) AS age_sum "
        f"FROM fact GROUP BY GROUPING SETS (({c}, Year, Month), ({c}, Year))"
        for c in REPORT_ATTRIBUTES
    )
    return f"{WITH_FACT} {' UNION ALL '.join(parts)}"


def _distinct_values() -> str:
    parts = (f"SELECT DISTINCT '{c}' AS field, {c} AS value FROM arr" for c in PROFILED)
    return f"{WITH_ARR} {' UNION ALL '.join(parts)}"


def _null_profile() -> str:
    def one(name: str) -> str:
        filled = f"count({name})" if name in KEPT_COLUMNS else "0"
        return (
            f"SELECT '{name}' AS field, count(*) AS rows, "
            f"CAST(count(*) - {filled} AS BIGINT) AS nulls, {filled} = 0 AS all_null FROM arr"
        )

    parts = (one(f.name) for f in RAW_ARRIVALS.fields)
    return f"{WITH_ARR} {' UNION ALL '.join(parts)}"


def _orphans() -> str:
    known = {
        "Year": "(SELECT year(o_orderdate) FROM orders)",
        "Month": "(SELECT month(o_orderdate) FROM orders)",
        "Monthly_Time": "(SELECT month(o_orderdate) || '_' || year(o_orderdate) FROM orders)",
        "Visa_Type": "('E1', 'E2', 'E3')",
        "Gender": "('M', 'F', 'X', 'U')",
        "Age_Group": "(1, 2, 3, 4, 5)",
        "Airport_Code": "(SELECT airport_code FROM airports)",
        "Airport_Municipality": "(SELECT municipality FROM airports)",
        "Airline_Code": "(SELECT airline_code FROM airlines)",
    }
    parts = (
        f"SELECT '{c}' AS field, CAST({c} AS VARCHAR) AS value, count(*) AS rows FROM fact "
        f"WHERE {c} IS NOT NULL AND {c} NOT IN {keys} GROUP BY {c}"
        for c, keys in known.items()
    )
    return f"{WITH_MART} {' UNION ALL '.join(parts)}"


def _dq_report() -> str:
    columns = [
        "CICID", "Year", "Month", "Day", "Monthly_Time", "Visa_Type", "Gender", "Age",
        "Age_Group", "Airport_Code", "Airport_Municipality", "Adm_Number", "Airline_Code",
        "Flight_Number",
    ]
    empty = " + ".join(f"CAST(count({c}) = 0 AS INTEGER)" for c in columns)
    days = "(SELECT CAST(cicid AS BIGINT) AS id, DATE '1960-01-01' + CAST(arrdate AS INTEGER) AS d FROM arr)"
    wrong = f"""(SELECT count(*) FROM fact JOIN {days} ON id = CAST(CICID AS BIGINT)
        WHERE Year <> year(d) OR Month <> month(d))"""
    keyless = """(SELECT count(*) FROM arr WHERE cicid IS NULL
        AND visatype IN ('1-URGENT', '2-HIGH', '3-MEDIUM'))"""
    odd = "(SELECT count(*) FROM fact WHERE Age < 0 OR Age > 120)"
    twice = "(SELECT count(*) FROM (SELECT CICID FROM fact GROUP BY CICID HAVING count(*) > 1))"
    checks = [
        _check("source_has_rows", "error", "count(*) > 0", "count(*)", "> 0") + " FROM arr",
        _check("arrival_number_present", "warning", f"{keyless} = 0", keyless, "0"),
        _check("corrupt_rows", "warning", "true", "0", "0"),
        _check("batch_not_empty", "error", "count(*) > 0", "count(*)", "> 0") + " FROM fact",
        _check("no_empty_column", "error", f"({empty}) = 0", empty, "0") + " FROM fact",
        _check("fact_column_count", "error", "14 = 14", "14", "14"),
        _check("period_matches", "error", f"{wrong} = 0", wrong, "0"),
        _check("key_not_null", "error", "count(*) = count(CICID)", "count(*) - count(CICID)", "0")
        + " FROM fact",
        _check("age_in_range", "warning", f"{odd} = 0", odd, "0"),
        _check("key_unique", "error", f"{twice} = 0", twice, "0"),
    ]
    return f"WITH arr AS ({ARR}), fact AS ({FACT}) {' UNION ALL '.join(checks)}"


def _dims_nonempty() -> str:
    tables = {
        "visatypes": "(VALUES (1), (2), (3))",
        "genders": "(VALUES (1), (2), (3), (4))",
        "agegroups": "(VALUES (1), (2), (3), (4), (5))",
        "years": f"(SELECT DISTINCT year FROM ({PERIODS}))",
        "months": f"(SELECT DISTINCT month_num FROM ({PERIODS}))",
        "monthlytimes": f"({PERIODS})",
        "airports": f"({CLEAN_AIRPORTS})",
        "airlines": f"({CLEAN_AIRLINES})",
        "municipalities": f"(SELECT DISTINCT municipality FROM ({CLEAN_AIRPORTS}))",
    }
    return " UNION ALL ".join(
        _check(f"{name}_has_rows", "error", "count(*) > 0", "count(*)", "> 0") + f" FROM {rows}"
        for name, rows in tables.items()
    )


KEPT = ", ".join(KEPT_COLUMNS)

ORACLE: dict[str, str] = {
    "fact_build": FACT,
    "required_not_null": f"""
        WITH arr AS ({ARR}), gaps AS (
            SELECT * REPLACE (nullif(visatype, '5-LOW') AS visatype) FROM arr)
        SELECT {KEPT} FROM gaps
        WHERE visatype IS NOT NULL AND i94port IS NOT NULL AND i94yr IS NOT NULL
          AND i94mon IS NOT NULL AND admnum IS NOT NULL""",
    "in_set_filter": f"""{WITH_ARR}
        SELECT cicid, visatype FROM arr WHERE visatype IN ('1-URGENT', '2-HIGH', '3-MEDIUM')""",
    "home_ports_semi": f"""{WITH_ARR}
        SELECT cicid, i94port FROM arr
        WHERE i94port IN (SELECT n_name FROM nation WHERE n_regionkey = 1)""",
    "dedup_first": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (
                PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST,
                         l_extendedprice NULLS FIRST, l_discount NULLS FIRST, l_tax NULLS FIRST,
                         l_returnflag NULLS FIRST, l_linestatus NULLS FIRST,
                         l_shipdate NULLS FIRST) AS rn
            FROM lineitem) WHERE rn = 1""",
    "sas_day": """
        SELECT o_orderkey, arrdate,
               DATE '1960-01-01' + CAST(floor(arrdate) AS INTEGER) AS arrival,
               CAST(day(DATE '1960-01-01' + CAST(floor(arrdate) AS INTEGER)) AS INTEGER) AS day
        FROM (SELECT o_orderkey,
                     CAST(CAST(o_orderdate AS DATE) - DATE '1960-01-01' AS DOUBLE) AS arrdate
              FROM orders)""",
    "admission_number": """
        SELECT o_orderkey, split_part(CAST(o_totalprice AS VARCHAR), '.', 1) AS admnum
        FROM orders""",
    "age_and_group": f"""{WITH_ARR}
        SELECT cicid, age,
               CAST(CASE WHEN age <= 25 THEN 1 WHEN age <= 35 THEN 2 WHEN age <= 45 THEN 3
                         WHEN age <= 59 THEN 4 WHEN age >= 60 THEN 5 END AS INTEGER) AS age_group
        FROM (SELECT cicid, CAST(i94yr AS INTEGER) - CAST(biryear AS INTEGER) AS age FROM arr)""",
    "fill_unknowns": f"""{WITH_ARR}
        SELECT cicid, coalesce(gender, 'U') AS gender, coalesce(airline, 'Unknown') AS airline
        FROM arr""",
    "double_to_int": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
               CAST(trunc(o_totalprice) AS INTEGER) AS price,
               CAST(trunc(-o_totalprice) AS INTEGER) AS refund,
               TRY_CAST(trunc(o_totalprice * 1e6) AS INTEGER) AS out_of_range
        FROM orders""",
    "period_mismatch": f"""{WITH_ARR}
        SELECT cicid, i94yr, i94mon FROM arr WHERE i94yr <> {REPORT_YEAR} OR i94mon <> 3""",
    "missing_values": f"{WITH_ARR} SELECT cicid, airline FROM arr WHERE airline IS NULL",
    "step_counts": f"""{WITH_ARR},
        flagged AS (
            SELECT visatype IS NOT NULL AND i94port IS NOT NULL AND i94yr IS NOT NULL
                   AND i94mon IS NOT NULL AND admnum IS NOT NULL AS present,
                   visatype IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AS class,
                   gender IS NOT NULL AS known
            FROM arr)
        SELECT CAST(0 AS INTEGER) AS step_no, 'read' AS step, count(*) AS rows FROM flagged
        UNION ALL SELECT 1, 'required_present', count(*) FROM flagged WHERE present
        UNION ALL SELECT 2, 'visa_class', count(*) FROM flagged WHERE present AND class
        UNION ALL SELECT 3, 'gender_known', count(*) FROM flagged
                  WHERE present AND class AND known""",
    "load_step_counts": f"""{WITH_ARR},
        flagged AS (
            SELECT cicid,
                   visatype IS NOT NULL AND i94port IS NOT NULL AND i94yr IS NOT NULL
                   AND i94mon IS NOT NULL AND admnum IS NOT NULL AS present,
                   visatype IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AS class,
                   i94port IN (SELECT airport_code FROM ({AIRPORTS})) AS home
            FROM arr)
        SELECT CAST(0 AS INTEGER) AS step_no, 'read' AS step, count(*) AS rows FROM flagged
        UNION ALL SELECT 1, 'required_present', count(*) FROM flagged WHERE present
        UNION ALL SELECT 2, 'visa_class', count(*) FROM flagged WHERE present AND class
        UNION ALL SELECT 3, 'home_airport', count(*) FROM flagged WHERE present AND class AND home
        UNION ALL SELECT 4, 'one_per_key', count(DISTINCT cicid) FROM flagged
                  WHERE present AND class AND home""",
    "dim_airports_clean": CLEAN_AIRPORTS,
    "dim_airlines_clean": CLEAN_AIRLINES,
    "dim_insert_distinct": f"SELECT DISTINCT municipality FROM ({AIRPORT_SOURCE})",
    "insert_if_absent": f"""
        SELECT event_id, CASE WHEN {FIRST_HALF} THEN 'kept' ELSE event_type END AS event_type, value
        FROM events""",
    "row_delta": f"""
        SELECT count(*) FILTER ({FIRST_HALF}) AS rows_before, count(*) AS rows_after,
               count(*) FILTER (NOT {FIRST_HALF}) AS rows_added
        FROM events""",
    "next_period": f"""
        WITH latest AS (
            SELECT year, max(month_num) AS month_num FROM ({PERIODS})
            WHERE year = (SELECT max(year) FROM ({PERIODS})) GROUP BY year),
        following AS (
            SELECT *, CASE WHEN month_num = 12 THEN year + 1 ELSE year END AS y,
                   CASE WHEN month_num = 12 THEN 1 ELSE month_num + 1 END AS m
            FROM latest)
        SELECT year AS latest_year, month_num AS latest_month,
               CAST(y AS INTEGER) AS next_year, CAST(m AS INTEGER) AS next_month,
               CAST(m AS VARCHAR) || '_' || CAST(y AS VARCHAR) AS monthlytime,
               strftime(make_date(2000, m, 1), '%b') AS month_name,
               right(CAST(y AS VARCHAR), 2) AS short_year
        FROM following""",
    "period_register": f"""
        SELECT CAST(month_num AS VARCHAR) || '_' || CAST(year AS VARCHAR) AS monthlytime,
               year, month_num, strftime(make_date(2000, month_num, 1), '%b') AS month_name
        FROM ({PERIODS})""",
    "total_rows": f"{WITH_FACT} SELECT count(*) AS rows FROM fact",
    "count_by_visa": f"""{WITH_FACT}
        SELECT Visa_Type, count(*) AS n FROM fact GROUP BY Visa_Type ORDER BY Visa_Type""",
    "count_by_agegroup": f"""{WITH_FACT},
        agegroups (agegroup_num, description) AS (VALUES
            (1, 'up to 25'), (2, '26-35'), (3, '36-45'), (4, '46-59'), (5, '60 and above'))
        SELECT CAST(agegroup_num AS INTEGER) AS Age_Group, description, count(*) AS n
        FROM fact JOIN agegroups ON Age_Group = agegroup_num
        GROUP BY agegroup_num, description ORDER BY agegroup_num""",
    "count_by_gender": f"{WITH_FACT} SELECT Gender, count(*) AS n FROM fact GROUP BY Gender",
    "count_by_month_in_year": f"""{WITH_FACT}
        SELECT Monthly_Time, count(*) AS n FROM fact WHERE Year = {REPORT_YEAR}
        GROUP BY Monthly_Time ORDER BY Monthly_Time""",
    "count_by_municipality": f"""{WITH_FACT}
        SELECT Airport_Municipality, count(*) AS n FROM fact GROUP BY Airport_Municipality""",
    "avg_age_three_ways": f"""{WITH_FACT},
        measured AS (
            SELECT avg(Age) AS avg_age, avg(Age) FILTER (Age_Group = 2) AS avg_age_in_group,
                   avg(Age) FILTER (Gender = 'F') AS avg_age_of_gender FROM fact)
        SELECT *, CAST(round_even(avg_age, 0) AS BIGINT) AS avg_age_rounded,
               CAST(round_even(avg_age_in_group, 0) AS BIGINT) AS avg_age_in_group_rounded,
               CAST(round_even(avg_age_of_gender, 0) AS BIGINT) AS avg_age_of_gender_rounded
        FROM measured""",
    "airline_lookup_limit": f"""{WITH_MART}
        SELECT CICID, Monthly_Time, Flight_Number, a.airline_code, airline_name, airline_country
        FROM fact JOIN airlines AS a ON fact.Airline_Code = a.airline_code
        ORDER BY CICID LIMIT 5""",
    "airport_lookup_limit": f"""{WITH_MART}
        SELECT fact.*, airport_type, name, municipality
        FROM fact JOIN airports AS a ON fact.Airport_Code = a.airport_code
        ORDER BY CICID LIMIT 5""",
    "airline_left_enrich": f"""{WITH_MART}
        SELECT CICID, fact.Airline_Code, airline_name, airline_country
        FROM fact LEFT JOIN airlines AS a ON fact.Airline_Code = a.airline_code""",
    "rollup_year_month_city": _rollup(["Year", "Month", "Airport_Municipality"]),
    "flights_over_time": _rollup(["Flight_Number", "Year", "Month"]),
    "airlines_over_time": _rollup(["Airline_Code", "Year", "Month"]),
    "attributes_over_time": _attributes(),
    "chart_points": _charts(),
    "sql_over_views": f"""{WITH_MART}
        SELECT a.airline_code, a.airline_name, count(*) AS n, avg(Age) AS avg_age
        FROM fact JOIN airlines AS a ON fact.Airline_Code = a.airline_code
        WHERE Year = {REPORT_YEAR} GROUP BY a.airline_code, a.airline_name""",
    "code_decode_other": f"""{WITH_ARR}
        SELECT cicid, i94port,
               CASE n_regionkey WHEN 4 THEN 'All Other Codes' WHEN 0 THEN 'INVALID: ' || n_name
                                ELSE n_name || ' PORT' END AS label,
               CASE n_regionkey WHEN 4 THEN 'other' WHEN 0 THEN 'invalid' ELSE 'valid' END
                   AS code_class
        FROM arr JOIN nation ON i94port = n_name""",
    "code_decode_number": """
        SELECT c_custkey, CAST(c_nationkey AS DOUBLE) AS country,
               CASE n_regionkey WHEN 4 THEN 'All Other Codes' WHEN 0 THEN 'INVALID: ' || n_name
                                ELSE n_name || ' PORT' END AS label,
               CASE n_regionkey WHEN 4 THEN 'other' WHEN 0 THEN 'invalid' ELSE 'valid' END
                   AS code_class
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "frequency_table": f"""{WITH_ARR}
        SELECT airline, count(*) AS n FROM arr WHERE airline IS NOT NULL
        GROUP BY airline ORDER BY n DESC, airline""",
    "distinct_values": _distinct_values(),
    "distinct_counts": f"""
        SELECT field, count(*) AS n_distinct FROM ({_distinct_values()}) GROUP BY field""",
    "null_profile": _null_profile(),
    "table_shape": "SELECT count(*) AS rows, CAST(11 AS INTEGER) AS columns FROM lineitem",
    "dq_report": _dq_report(),
    "dq_repeated_keys": _check("key_unique", "error", "count(*) = 0", "count(*)", "0")
    + " FROM (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1)",
    "dq_dims_nonempty": _dims_nonempty(),
    "dq_orphan_keys": _orphans(),
    "typed_csv_scan": f"{WITH_ARR} SELECT {KEPT} FROM arr",
    "landed_period": f"{WITH_ARR} SELECT {KEPT} FROM arr",
    "airport_csv_scan": AIRPORT_SOURCE,
    "warehouse_dimensions": f"""
        SELECT 'airports' AS dimension, airport_code AS key FROM ({CLEAN_AIRPORTS})
        UNION ALL SELECT DISTINCT 'municipalities', municipality FROM ({CLEAN_AIRPORTS})
        UNION ALL SELECT 'airlines', airline_code FROM ({CLEAN_AIRLINES})
        UNION ALL SELECT 'visatypes', * FROM (VALUES ('E1'), ('E2'), ('E3'))
        UNION ALL SELECT 'genders', * FROM (VALUES ('M'), ('F'), ('X'), ('U'))
        UNION ALL SELECT 'agegroups', * FROM (VALUES ('1'), ('2'), ('3'), ('4'), ('5'))""",
    "monthly_increment": FACT,
    "refused_load": f"""{WITH_FACT}, months AS (
            SELECT DISTINCT Year, Month FROM fact),
        earlier AS (
            SELECT fact.* FROM fact ANTI JOIN (
                SELECT * FROM months ORDER BY Year DESC, Month DESC LIMIT 2) USING (Year, Month)),
        counts AS (
            SELECT count(*) AS fact_rows, count(DISTINCT Monthly_Time) AS registered FROM earlier)
        SELECT 'mixed' AS step, 'period_matches' AS failed, * FROM counts
        UNION ALL SELECT 'idle', 'fact_grew', * FROM counts
        UNION ALL SELECT 'corrected', 'none', count(*), count(DISTINCT Monthly_Time) FROM fact""",
    "arriving_periods": f"""{WITH_FACT}
        SELECT * FROM fact WHERE Year <> {BAD_MONTH[0]} OR Month <> {BAD_MONTH[1]}""",
    "bootstrap_from_files": f"""{WITH_MART}
        SELECT 'airports' AS stored_in, airport_code AS key FROM airports
        UNION ALL SELECT 'airlines', airline_code FROM airlines
        UNION ALL SELECT 'immigrationfacts', CICID FROM fact""",
    "restated_period": f"""{WITH_FACT}
        SELECT * REPLACE (CASE WHEN Year = {BAD_MONTH[0]} AND Month = {BAD_MONTH[1]} THEN 'X' ELSE Gender END AS Gender)
        FROM fact WHERE NOT (Year = {BAD_MONTH[0]} AND Month = {BAD_MONTH[1]} AND CAST(CICID AS BIGINT) % 3 = 0)""",
    "rollup_after_increment": _kept_rollups(),
    "distinct_by_sketch": f"""{WITH_FACT}, long AS (
            SELECT Year, Month, unnest(['Flight_Number', 'Airline_Code', 'Adm_Number']) AS field,
                   unnest([Flight_Number, Airline_Code, Adm_Number]) AS value FROM fact)
        SELECT field, Year, Month, count(DISTINCT value) AS exact, true AS "close"
        FROM long GROUP BY GROUPING SETS ((field, Year, Month), (field, Year))""",
    "compacted_fact": FACT,
    "load_rejects": f"""{WITH_ARR}, placed AS (
            SELECT strftime(make_date(CAST(i94yr AS INTEGER), CAST(i94mon AS INTEGER), 1), '%Y-%m') AS delivery, cicid,
                   i94yr = {BAD_MONTH[0]} AND i94mon = {BAD_MONTH[1]} AS headless
            FROM arr), numbered AS (
            SELECT *, 1 + row_number() OVER (PARTITION BY delivery ORDER BY cicid) AS line FROM placed)
        SELECT delivery, line, CASE WHEN headless THEN 'header' ELSE 'values' END AS reason, cicid
        FROM numbered WHERE headless OR cicid % 50 = 0
        UNION ALL SELECT NULL, NULL, 'good', cicid FROM numbered WHERE NOT (headless OR cicid % 50 = 0)""",
    "code_dictionary": """
        SELECT 'country' AS domain, CAST(n_nationkey AS VARCHAR) AS code,
               CASE WHEN n_regionkey = 0 THEN 'INVALID: ' || n_name ELSE n_name END AS label,
               CASE WHEN n_regionkey = 0 THEN 'invalid' ELSE 'valid' END AS code_class FROM nation
        UNION ALL SELECT 'port', 'S' || s_suppkey, s_name || chr(39) || 's', 'valid' FROM supplier
        UNION ALL SELECT 'visa_category', code, label, 'valid'
        FROM (VALUES ('1', 'Business'), ('2', 'Pleasure'), ('3', 'Student')) AS visa (code, label)""",
    "dropped_and_refilled": f"""{WITH_MART}, counts AS (
            SELECT 'immigrationfacts' AS name, count(*) AS n, false AS kept FROM fact
            UNION ALL SELECT 'years', count(DISTINCT Year), false FROM fact
            UNION ALL SELECT 'months', count(DISTINCT Month), false FROM fact
            UNION ALL SELECT 'monthlytimes', count(DISTINCT Monthly_Time), false FROM fact
            UNION ALL SELECT 'airports', count(*), true FROM airports
            UNION ALL SELECT 'airlines', count(*), true FROM airlines
            UNION ALL SELECT 'municipalities', count(DISTINCT municipality), true FROM airports
            UNION ALL SELECT * FROM (VALUES ('visatypes', 3, true), ('genders', 4, true), ('agegroups', 5, true)))
        SELECT step, name, CASE WHEN step = 'reset' AND NOT kept THEN 0 ELSE n END AS n
        FROM counts CROSS JOIN (VALUES ('filled'), ('reset'), ('refilled')) AS steps (step)""",
    "refused_starts": f"""{WITH_FACT}, following AS (
            SELECT max(Year * 12 + Month) AS m FROM fact)
        SELECT 'no file' AS step, 'F_' || (m % 12 + 1) || '_' || (m // 12) || '.csv' AS outcome FROM following
        UNION ALL SELECT 'no fact', 'fact_exists'
        UNION ALL SELECT 'empty register', 'monthlytimes has no rows'
        UNION ALL SELECT 'no register', 'monthlytimes does not exist'""",
    "fact_from_lineitem": _fact(LINES),
    "keyless_lines": f"WITH arr AS ({LINES}) "
    + " UNION ALL ".join(
        [
            _check("source_has_rows", "error", "count(*) > 0", "count(*)", "> 0") + " FROM arr",
            _check("arrival_number_present", "warning", "count(*) = 0", "count(*)", "0")
            + " FROM arr WHERE cicid IS NULL",
            _check("corrupt_rows", "warning", "true", "0", "0"),
        ]
    ),
    # The first delivery is a part of the second, so the fact holds every arrival once.
    "warehouse_loaded_fact": f"""{WITH_FACT}
        SELECT * FROM fact WHERE Year < {SECOND_DELIVERY_YEAR}
        UNION ALL SELECT * FROM fact WHERE Year >= {SECOND_DELIVERY_YEAR}""",
}
