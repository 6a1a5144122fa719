"""Registered queries: name to ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.config import REQUIRED_FIELDS
from starmart.driver import adapters as ad
from starmart.functions import (
    admission_number,
    age_group,
    age_in_year,
    as_integer,
    fill_unknown,
    following_period,
    key_text,
    month_key,
    month_name,
    sas_date,
    sas_day,
    short_year,
)
from starmart.operators import dimensions, filters, summaries
from starmart.operators.dedup import first_per_key
from starmart.operators.insert import absent_rows, insert_if_absent
from starmart.operators.lookup import decode
from starmart.operators.profile import null_profile, shape
from starmart.plans import fact as fact_plan
from starmart.plans import jobs, maintenance, marts, quality, rollups
from starmart.schemas import DIMENSIONS, FACT_TABLE, KEPT_COLUMNS, PERIOD_DIMENSIONS, key_of
from starmart.session import scratch_path
from starmart.sources import landing, paths, rejects
from starmart.sources.codebook import read_codebook
from starmart.sources.dimension_files import read_airports
from starmart.sources.raw import kept, raw_file_name, read_raw
from starmart.sources.warehouse import Warehouse
from starmart.streaming.arrivals import load_arriving

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PROFILED = ("gender", "airline", "visatype", "i94port", "fltno")
SECOND_DELIVERY_YEAR = 1998
BAD_MONTH = (1995, 6)


def registered(query: Query) -> Query:
    QUERIES[query.__name__.removesuffix("_query")] = query
    return query


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    home = ad.home_airports(spark, sf_dir)
    return fact_plan.fact_rows(ad.arrivals(spark, sf_dir, home), home, ad.ORDERS_CONFIG)


def _dimensions(
    spark: SparkSession, sf_dir: str, airports: DataFrame, airlines: DataFrame
) -> dict[str, DataFrame]:
    return {
        **{name: dimensions.seed(spark, name) for name in dimensions.SEEDS},
        **dimensions.period_rows(ad.order_periods(spark, sf_dir)),
        "airports": airports,
        "airlines": airlines,
        "municipalities": dimensions.municipalities(airports),
    }


# The fact and its steps.


@registered
def fact_build(spark, sf_dir):
    return _fact(spark, sf_dir)


@registered
def required_not_null(spark, sf_dir):
    """One order priority stands for a missing visa class."""
    gaps = ad.arrivals(spark, sf_dir).withColumn(
        "visatype", F.nullif(F.col("visatype"), F.lit("5-LOW"))
    )
    return gaps.filter(filters.all_present(REQUIRED_FIELDS)).select(*KEPT_COLUMNS)


@registered
def in_set_filter(spark, sf_dir):
    rows = ad.arrivals(spark, sf_dir)
    kept_rows = rows.filter(filters.in_values("visatype", ad.ORDERS_CONFIG.visa_classes))
    return kept_rows.select("cicid", "visatype")


@registered
def home_ports_semi(spark, sf_dir):
    rows = ad.arrivals(spark, sf_dir).select("cicid", "i94port")
    return filters.in_dimension(rows, "i94port", ad.home_airports(spark, sf_dir), "airport_code")


@registered
def dedup_first(spark, sf_dir):
    return first_per_key(ad.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@registered
def sas_day_query(spark, sf_dir):
    days = F.col("arrdate")
    return ad.orders(spark, sf_dir).select(
        "o_orderkey", "arrdate", sas_date(days).alias("arrival"), sas_day(days).alias("day")
    )


@registered
def admission_number_query(spark, sf_dir):
    price = F.col("o_totalprice").cast("string")
    return ad.orders(spark, sf_dir).select("o_orderkey", admission_number(price).alias("admnum"))


@registered
def age_and_group(spark, sf_dir):
    age = age_in_year(as_integer(F.col("i94yr")), as_integer(F.col("biryear")))
    rows = ad.arrivals(spark, sf_dir)
    return rows.select("cicid", age.alias("age"), age_group(age).alias("age_group"))


@registered
def fill_unknowns(spark, sf_dir):
    return ad.arrivals(spark, sf_dir).select(
        "cicid",
        fill_unknown(F.col("gender"), ad.ORDERS_CONFIG.unknown_gender).alias("gender"),
        fill_unknown(F.col("airline"), ad.ORDERS_CONFIG.unknown_airline).alias("airline"),
    )


@registered
def double_to_int(spark, sf_dir):
    return ad.orders(spark, sf_dir).select(
        key_text(F.col("o_orderkey").cast("double")).alias("order_id"),
        as_integer(F.col("o_totalprice")).alias("price"),
        as_integer(-F.col("o_totalprice")).alias("refund"),
        as_integer(F.col("o_totalprice") * 1e6).alias("out_of_range"),
    )


@registered
def period_mismatch(spark, sf_dir):
    rows = ad.arrivals(spark, sf_dir).select("cicid", "i94yr", "i94mon")
    return rows.filter(
        filters.outside_period("i94yr", "i94mon", F.lit(ad.REPORT_YEAR), F.lit(3))
    )


@registered
def missing_values(spark, sf_dir):
    return filters.missing(ad.arrivals(spark, sf_dir).select("cicid", "airline"), "airline")


@registered
def step_counts(spark, sf_dir):
    steps = fact_plan.cleaning_steps(ad.ORDERS_CONFIG)
    steps["gender_known"] = filters.all_present(["gender"])
    return summaries.step_counts(ad.arrivals(spark, sf_dir), steps)


@registered
def load_step_counts(spark, sf_dir):
    return fact_plan.load_step_counts(
        ad.arrivals(spark, sf_dir), ad.home_airports(spark, sf_dir), ad.ORDERS_CONFIG
    )


# Dimensions.


@registered
def dim_airports_clean(spark, sf_dir):
    return dimensions.clean_airports(ad.airport_source(spark, sf_dir), ad.ORDERS_CONFIG)


@registered
def dim_airlines_clean(spark, sf_dir):
    return dimensions.clean_airlines(ad.airline_source(spark, sf_dir), ad.ORDERS_CONFIG)


@registered
def dim_insert_distinct(spark, sf_dir):
    """Municipalities of the clean airports are there; those of all airports arrive."""
    source = ad.airport_source(spark, sf_dir)
    existing = dimensions.municipalities(dimensions.clean_airports(source, ad.ORDERS_CONFIG))
    incoming = dimensions.municipalities(source)
    return insert_if_absent(incoming, existing, "municipality")


@registered
def insert_if_absent_query(spark, sf_dir):
    """Events of the first half of the month are there; the whole feed arrives again."""
    events = ad.table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    first_half = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    existing = (
        ad.table(spark, sf_dir, "events")
        .filter(first_half)
        .select("event_id", F.lit("kept").alias("event_type"), "value")
    )
    return insert_if_absent(events, existing, "event_id")


@registered
def row_delta(spark, sf_dir):
    """Rows before and after inserting the whole feed over its first half."""
    events = ad.table(spark, sf_dir, "events")
    existing = events.filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    added = absent_rows(events.select("event_id"), existing.select("event_id"), "event_id")
    tagged = existing.select(F.lit(0).alias("new")).unionByName(added.select(F.lit(1).alias("new")))
    return tagged.agg(
        F.count_if(F.col("new") == 0).alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
        F.count_if(F.col("new") == 1).alias("rows_added"),
    )


@registered
def next_period(spark, sf_dir):
    """Latest period of the orders and the names made for the one after it."""
    latest = summaries.latest_period(ad.order_periods(spark, sf_dir), "year", "month_num")
    following = latest.select(
        F.col("year").alias("latest_year"),
        F.col("month_num").alias("latest_month"),
        following_period(F.col("year"), F.col("month_num")).alias("p"),
    )
    year, month = F.col("p.year"), F.col("p.month_num")
    return following.select(
        "latest_year",
        "latest_month",
        year.alias("next_year"),
        month.alias("next_month"),
        month_key(year, month).alias("monthlytime"),
        month_name(month).alias("month_name"),
        short_year(year).alias("short_year"),
    )


@registered
def period_register(spark, sf_dir):
    rows = dimensions.period_rows(ad.order_periods(spark, sf_dir))["monthlytimes"]
    return rows.select("*", month_name(F.col("month_num")).alias("month_name"))


# Reports.


@registered
def total_rows(spark, sf_dir):
    return marts.total_rows(_fact(spark, sf_dir))


@registered
def count_by_visa(spark, sf_dir):
    return marts.by_visa_type(_fact(spark, sf_dir))


@registered
def count_by_agegroup(spark, sf_dir):
    return marts.by_age_group(_fact(spark, sf_dir), dimensions.seed(spark, "agegroups"))


@registered
def count_by_gender(spark, sf_dir):
    return marts.by_gender(_fact(spark, sf_dir))


@registered
def count_by_month_in_year(spark, sf_dir):
    return marts.by_month(_fact(spark, sf_dir), ad.REPORT_YEAR, text_order=True)


@registered
def count_by_municipality(spark, sf_dir):
    return marts.by_municipality(_fact(spark, sf_dir))


@registered
def avg_age_three_ways(spark, sf_dir):
    return marts.average_ages(_fact(spark, sf_dir), 2, "F")


@registered
def airline_lookup_limit(spark, sf_dir):
    return marts.flights_with_airline(
        _fact(spark, sf_dir), ad.segment_airlines(spark, sf_dir)
    )


@registered
def airport_lookup_limit(spark, sf_dir):
    return marts.arrivals_with_airport(_fact(spark, sf_dir), ad.home_airports(spark, sf_dir))


@registered
def airline_left_enrich(spark, sf_dir):
    return fact_plan.with_airline(
        _fact(spark, sf_dir).select("CICID", "Airline_Code"),
        ad.segment_airlines(spark, sf_dir),
    )


@registered
def rollup_year_month_city(spark, sf_dir):
    return marts.rollup_by_time_and_city(_fact(spark, sf_dir))


@registered
def flights_over_time(spark, sf_dir):
    return marts.over_time(_fact(spark, sf_dir), "Flight_Number")


@registered
def airlines_over_time(spark, sf_dir):
    return marts.over_time(_fact(spark, sf_dir), "Airline_Code")


@registered
def attributes_over_time(spark, sf_dir):
    return marts.attributes_over_time(_fact(spark, sf_dir))


@registered
def chart_points(spark, sf_dir):
    return marts.chart_points(_fact(spark, sf_dir))


@registered
def sql_over_views(spark, sf_dir):
    """Ad-hoc SQL over views of the mart, with a bound parameter."""
    _fact(spark, sf_dir).createOrReplaceTempView(FACT_TABLE)
    ad.segment_airlines(spark, sf_dir).createOrReplaceTempView("airlines")
    return spark.sql(
        f"""
        SELECT a.airline_code, a.airline_name, count(*) AS n, avg(i.Age) AS avg_age
        FROM {FACT_TABLE} AS i INNER JOIN airlines AS a ON i.Airline_Code = a.airline_code
        WHERE i.Year = :year
        GROUP BY a.airline_code, a.airline_name
        """,
        args={"year": ad.REPORT_YEAR},
    )


@registered
def code_decode_other(spark, sf_dir):
    rows = ad.arrivals(spark, sf_dir).select("cicid", "i94port")
    return decode(rows, F.col("i94port"), ad.nation_codebook(spark, sf_dir), "port")


@registered
def code_decode_number(spark, sf_dir):
    """Country codes arrive as doubles; the dictionary lists them as text."""
    code = F.col("c_nationkey").cast("double")
    rows = ad.table(spark, sf_dir, "customer").select("c_custkey", code.alias("country"))
    return decode(rows, key_text(F.col("country")), ad.nation_codebook(spark, sf_dir), "country")


# Profiles.


@registered
def frequency_table(spark, sf_dir):
    return summaries.frequencies(ad.arrivals(spark, sf_dir), "airline")


@registered
def distinct_values(spark, sf_dir):
    return summaries.distinct_values(ad.arrivals(spark, sf_dir), PROFILED)


@registered
def distinct_counts(spark, sf_dir):
    return summaries.distinct_counts(ad.arrivals(spark, sf_dir), PROFILED)


@registered
def null_profile_query(spark, sf_dir):
    """Raw arrivals: the columns the fact does not use are empty here."""
    return null_profile(ad.raw_arrivals(spark, sf_dir))


@registered
def table_shape(spark, sf_dir):
    return shape(ad.table(spark, sf_dir, "lineitem"))


# Checks.


def _delivered_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows with the period of their arrival date as the one they were delivered for."""
    day = sas_date(F.col("arrdate"))
    rows = ad.arrivals(spark, sf_dir).withColumns(
        {"load_year": F.year(day), "load_month": F.month(day)}
    )
    return fact_plan.fact_rows(rows, ad.home_airports(spark, sf_dir), ad.ORDERS_CONFIG)


@registered
def dq_report(spark, sf_dir):
    rows = ad.arrivals(spark, sf_dir)
    qualifies = filters.in_values("visatype", ad.ORDERS_CONFIG.visa_classes)
    batch = _delivered_fact(spark, sf_dir)
    return quality.union(
        [
            quality.source_checks(rows, qualifies),
            quality.batch_and_key_checks(batch),
        ]
    )


@registered
def dq_repeated_keys(spark, sf_dir):
    """The key check on a table whose key does repeat."""
    return quality.key_checks(ad.table(spark, sf_dir, "lineitem"), "l_orderkey")


@registered
def dq_dims_nonempty(spark, sf_dir):
    airports = dimensions.clean_airports(ad.airport_source(spark, sf_dir), ad.ORDERS_CONFIG)
    airlines = dimensions.clean_airlines(ad.airline_source(spark, sf_dir), ad.ORDERS_CONFIG)
    return quality.dimension_checks(spark, _dimensions(spark, sf_dir, airports, airlines))


@registered
def dq_orphan_keys(spark, sf_dir):
    """Order priorities are no visa types, and one segment and a missing one are no airlines."""
    airports, airlines = ad.home_airports(spark, sf_dir), ad.segment_airlines(spark, sf_dir)
    return quality.fact_orphans(
        _fact(spark, sf_dir), _dimensions(spark, sf_dir, airports, airlines)
    )


# Files and jobs, on data that Spark derives from the given tables.


@registered
def typed_csv_scan(spark, sf_dir):
    """Write the arrivals as raw CSV, read them back by the declared schema."""
    path = scratch_path(spark, "raw-csv")
    ad.raw_arrivals(spark, sf_dir).write.option("header", True).csv(path)
    return kept(read_raw(spark, path))


@registered
def airport_csv_scan(spark, sf_dir):
    """Write the uncleaned airports as CSV, read them back by name."""
    path = scratch_path(spark, "airports-csv")
    ad.airport_source(spark, sf_dir).write.option("header", True).csv(path)
    return read_airports(spark, path)


@registered
def landed_period(spark, sf_dir):
    """Deliver all arrivals as the raw file of one period, land it and read the landing."""
    root = scratch_path(spark, "landing")
    incoming = f"{root}/incoming"
    delivery = f"{incoming}/{raw_file_name(ad.REPORT_YEAR, 1)}"
    ad.raw_arrivals(spark, sf_dir).write.option("header", True).csv(delivery)
    landing.land(spark, incoming, f"{root}/landed", ad.REPORT_YEAR, 1)
    return landing.read_landed(spark, f"{root}/landed", ad.REPORT_YEAR, 1).select(*KEPT_COLUMNS)


@registered
def warehouse_dimensions(spark, sf_dir):
    """Keys of the dimensions after a reset and two set-ups with the same sources."""
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    sources = ad.airport_source(spark, sf_dir), ad.airline_source(spark, sf_dir)
    jobs.set_up(warehouse, *sources, ad.ORDERS_CONFIG)
    jobs.fill_dimensions(warehouse, *sources, ad.ORDERS_CONFIG)
    filled = [name for name in DIMENSIONS if name not in PERIOD_DIMENSIONS]
    keys = [
        warehouse.read(name).select(
            F.lit(name).alias("dimension"), F.col(key_of(name)).cast("string").alias("key")
        )
        for name in filled
    ]
    return reduce(DataFrame.unionByName, keys)


def _prepared_mart(spark: SparkSession, sf_dir: str) -> jobs.MartJob:
    root = scratch_path(spark, "mart")
    job = jobs.MartJob(
        spark,
        f"{root}/incoming",
        f"{root}/landed",
        Warehouse(spark, f"{root}/warehouse"),
        ad.ORDERS_CONFIG,
    )
    ports, carriers = ad.port_source(spark, sf_dir), ad.carrier_source(spark, sf_dir)
    jobs.set_up(job.warehouse, ports, carriers, job.config)
    return job


def _with_load_period(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {"load_year": as_integer(F.col("i94yr")), "load_month": as_integer(F.col("i94mon"))}
    )


def _deliver(job: jobs.MartJob, rows: DataFrame, year: int, month: int) -> None:
    """Write the raw file of a period, as a folder of parts."""
    target = f"{job.incoming}/{raw_file_name(year, month)}"
    rows.write.mode("overwrite").option("header", True).csv(target)


def _deliver_all(job: jobs.MartJob, rows: DataFrame) -> None:
    """Write the raw files of all months in rows, one folder of parts each, in one pass."""
    year, month = (F.col(c).cast("int").cast("string") for c in ("i94yr", "i94mon"))
    name = F.concat(F.lit("F_"), month, F.lit("_"), year, F.lit(".csv"))
    folder = f"{job.incoming}-written"
    named = rows.withColumn("delivery", name).repartition("delivery")
    named.write.partitionBy("delivery").option("header", True).csv(folder)
    for written in paths.names_in(job.spark, folder):
        if written.startswith("delivery="):
            target = f"{job.incoming}/{written.removeprefix('delivery=')}"
            paths.move(job.spark, f"{folder}/{written}", target)
            paths.mark_complete(job.spark, target)


def _last_months(spark: SparkSession, sf_dir: str, n: int = 1) -> list[jobs.Period]:
    """The last months with fact rows, the latest one last."""
    months = _fact(spark, sf_dir).select("Year", "Month").distinct()
    return [(r.Year, r.Month) for r in months.orderBy(F.desc("Year"), F.desc("Month")).limit(n).collect()][::-1]


def _is_month(period: jobs.Period) -> Column:
    return filters.in_period("i94yr", "i94mon", F.lit(period[0]), F.lit(period[1]))


@registered
def monthly_increment(spark, sf_dir):
    """Load all months but the last with fact rows, deliver that as raw CSV and advance to it."""
    job = _prepared_mart(spark, sf_dir)
    year, month = F.col("Year").alias("year"), F.col("Month").alias("month_num")
    last = summaries.latest_period(_fact(spark, sf_dir).select(year, month), "year", "month_num").first()
    last_month = _is_month((last["year"], last["month_num"]))
    earlier = ad.arrivals(spark, sf_dir).filter(~last_month)
    jobs.load_batch(job.warehouse, _with_load_period(earlier), job.config)
    _deliver(job, ad.raw_arrivals(spark, sf_dir).filter(last_month), last["year"], last["month_num"])
    jobs.advance(job)
    return job.warehouse.read(FACT_TABLE)


@registered
def refused_load(spark, sf_dir):
    """All months but two are loaded; then the last two come, in batches that are refused, and corrected.

    First the rows of the last month are labelled as of the month before, then the last month repeats
    numbers of a loaded month and so adds nothing. Each time fact and register stay as they were.
    """
    job = _prepared_mart(spark, sf_dir)
    loaded, before, last = _last_months(spark, sf_dir, 3)
    arrivals = ad.arrivals(spark, sf_dir)
    two = _is_month(before) | _is_month(last)
    jobs.load_batch(job.warehouse, _with_load_period(arrivals.filter(~two)), job.config)
    late = arrivals.filter(two)
    mixed = late.withColumns({"load_year": F.lit(before[0]), "load_month": F.lit(before[1])})
    relabelled = {"i94yr": F.lit(float(last[0])), "i94mon": F.lit(float(last[1]))}
    known = arrivals.filter(_is_month(loaded)).withColumns(relabelled)
    repeated = late.filter(_is_month(before)).unionByName(known)
    steps = {"mixed": mixed, "idle": _with_load_period(repeated), "corrected": _with_load_period(late)}
    states = []
    for step, batch in steps.items():
        try:
            jobs.load_batch(job.warehouse, batch, job.config)
            failed = "none"
        except quality.QualityError as error:
            failed = str(error).split(":")[0]
        tables = {"fact_rows": FACT_TABLE, "registered": "monthlytimes"}
        rows = [job.warehouse.read(table).select(F.lit(name).alias("of")) for name, table in tables.items()]
        totals = reduce(DataFrame.unionAll, rows).agg(*(F.count_if(F.col("of") == n).alias(n) for n in tables)).first()
        counts = {name: F.lit(n).cast("long") for name, n in totals.asDict().items()}
        states.append({"step": F.lit(step), "failed": F.lit(failed), **counts})
    return quality.literal_rows(spark, states)


@registered
def arriving_periods(spark, sf_dir):
    """The raw files of all months arrive at once, one of them with rows of another month; then one more.

    The bad file is that of the middle month. It is put aside, the others are loaded.
    """
    job = _prepared_mart(spark, sf_dir)
    raw = ad.raw_arrivals(spark, sf_dir)
    last = _last_months(spark, sf_dir)[-1]
    checkpoint = job.warehouse.scratch("arrivals")
    _deliver_all(job, raw.filter(~_is_month(last)))
    _deliver(job, raw.filter(_is_month(BAD_MONTH) | _is_month(last)), *BAD_MONTH)
    _run_arrivals(job, checkpoint)
    _deliver(job, raw.filter(_is_month(last)), *last)
    _run_arrivals(job, checkpoint)
    return job.warehouse.read(FACT_TABLE)


def _run_arrivals(job: jobs.MartJob, checkpoint: str) -> None:
    run = load_arriving(job, checkpoint)
    run.awaitTermination()
    if run.exception():
        raise run.exception()


@registered
def bootstrap_from_files(spark, sf_dir):
    """A first run from an airport CSV, airlines as JSON Lines and the raw file of a month; the other months follow."""
    root = scratch_path(spark, "bootstrap")
    job = jobs.MartJob(
        spark, f"{root}/incoming", f"{root}/landed", Warehouse(spark, f"{root}/warehouse"), ad.ORDERS_CONFIG
    )
    raw = ad.raw_arrivals(spark, sf_dir)
    first = raw.agg(F.min(F.struct(F.col("i94yr").cast("int"), F.col("i94mon").cast("int")))).first()[0]
    _deliver_all(job, raw)
    ad.port_source(spark, sf_dir).write.option("header", True).csv(f"{root}/airports.csv")
    ad.carrier_source(spark, sf_dir).write.json(f"{root}/airlines.json")
    jobs.bootstrap(job, f"{root}/airports.csv", f"{root}/airlines.json", *first)
    _run_arrivals(job, f"{root}/arrivals")
    keys = [
        job.warehouse.read(name).select(F.lit(name).alias("stored_in"), F.col(key_of(name)).alias("key"))
        for name in ("airports", "airlines", FACT_TABLE)
    ]
    return reduce(DataFrame.unionByName, keys)


@registered
def restated_period(spark, sf_dir):
    """All months are loaded; then a corrected file of one replaces it, without every third arrival and with other genders."""
    job = _prepared_mart(spark, sf_dir)
    jobs.load_batch(job.warehouse, _with_load_period(ad.arrivals(spark, sf_dir)), job.config)
    corrected = ad.raw_arrivals(spark, sf_dir).filter(_is_month(BAD_MONTH) & (F.col("cicid") % 3 != 0))
    _deliver(job, corrected.withColumn("gender", F.lit("X")), *BAD_MONTH)
    jobs.restate_period(job, *BAD_MONTH)
    return job.warehouse.read(FACT_TABLE)


def _loaded_mart(spark: SparkSession, sf_dir: str, months: Column | None = None) -> jobs.MartJob:
    """A mart with all arrivals, or those of some months, loaded as one batch."""
    job = _prepared_mart(spark, sf_dir)
    arrivals = ad.arrivals(spark, sf_dir)
    rows = arrivals if months is None else arrivals.filter(months)
    jobs.load_batch(job.warehouse, _with_load_period(rows), job.config)
    return job


def _incremented(spark: SparkSession, sf_dir: str) -> jobs.MartJob:
    """All months but the last are loaded and rolled up; the last one is delivered, loaded and rolled up alone."""
    last = _last_months(spark, sf_dir)[-1]
    job = _loaded_mart(spark, sf_dir, ~_is_month(last))
    rollups.refresh(job.warehouse)
    _deliver(job, ad.raw_arrivals(spark, sf_dir).filter(_is_month(last)), *last)
    jobs.advance(job)
    rollups.refresh(job.warehouse)
    return job


@registered
def rollup_after_increment(spark, sf_dir):
    """Kept roll-ups by month and year after an increment; only the new month's rows are read for it."""
    return rollups.attributes_over_time(_incremented(spark, sf_dir).warehouse)


@registered
def distinct_by_sketch(spark, sf_dir):
    """Distinct values from kept sketches beside the exact numbers: whether they are within 3 %."""
    warehouse = _incremented(spark, sf_dir).warehouse
    fields = [F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in rollups.SKETCHED]
    values = warehouse.read(FACT_TABLE).select("Year", "Month", F.inline(F.array(*fields)))
    levels = [["field", "Year", "Month"], ["field", "Year"]]
    exact = values.groupingSets(levels, "field", "Year", "Month").agg(F.count_distinct("value").alias("exact"))
    estimated = rollups.distinct_over_time(warehouse).withColumnsRenamed({"field": "_field", "Year": "_year", "Month": "_month"})
    same = [F.col(a).eqNullSafe(F.col(b)) for a, b in (("field", "_field"), ("Year", "_year"), ("Month", "_month"))]
    close = F.abs(F.col("estimate") - F.col("exact")) <= 0.03 * F.col("exact")
    return exact.join(estimated, same).select("field", "Year", "Month", "exact", close.alias("close"))


@registered
def compacted_fact(spark, sf_dir):
    """The fact after three loads of a third of the arrivals each and a compaction of its files."""
    job = _prepared_mart(spark, sf_dir)
    arrivals = _with_load_period(ad.arrivals(spark, sf_dir))
    for third in range(3):
        jobs.load_batch(job.warehouse, arrivals.filter(F.col("cicid") % 3 == third), job.config)
    maintenance.compact(job.warehouse)
    return job.warehouse.read(FACT_TABLE)


@registered
def load_rejects(spark, sf_dir):
    """Lines of a delivery that do not fit: every 50th arrival has no number as year, a month's file no header."""
    root = scratch_path(spark, "deliveries")
    raw = ad.raw_arrivals(spark, sf_dir)
    month = F.col("i94mon").cast("int").cast("string")
    month = F.concat_ws("-", F.col("i94yr").cast("int").cast("string"), F.lpad(month, 2, "0"))
    bad_year = F.when(F.col("cicid") % 50 == 0, F.lit("year?")).otherwise(F.col("i94yr").cast("string"))
    columns = [bad_year if c == "i94yr" else F.col(c).cast("string") for c in raw.columns]
    value = F.concat_ws(",", *(F.coalesce(c, F.lit("")) for c in columns))
    header = F.when(month == f"{BAD_MONTH[0]}-{BAD_MONTH[1]:02}", "no,header").otherwise(rejects.HEADER)
    text = raw.select(month.alias("delivery"), F.col("cicid").alias("place"), value.alias("value"))
    heads = raw.select(month.alias("delivery"), F.lit(-1.0).alias("place"), header.alias("value")).distinct()
    lines = text.union(heads).repartition("delivery").sortWithinPartitions("delivery", "place")
    lines.select("value", "delivery").write.partitionBy("delivery").text(f"{root}/incoming")
    rejects.load_lines(spark, [f"{root}/incoming"], f"{root}/good", f"{root}/rejected", f"{root}/lines")
    found = spark.read.parquet(f"{root}/rejected").select(
        F.regexp_extract("file", r"delivery=([0-9-]+)", 1).alias("delivery"),
        "line",
        "reason",
        F.split("text", ",")[0].cast("double").alias("cicid"),
    )
    good = spark.read.parquet(f"{root}/good").select("cicid").withColumn("reason", F.lit("good"))
    return found.unionByName(good, allowMissingColumns=True)


@registered
def code_dictionary(spark, sf_dir):
    """Nations and suppliers as the lists of a dictionary file, read back."""
    root = scratch_path(spark, "dictionary")
    nation, supplier = ad.table(spark, sf_dir, "nation"), ad.table(spark, sf_dir, "supplier")
    marked = F.when(F.col("n_regionkey") == 0, F.concat(F.lit("INVALID: "), "n_name")).otherwise(F.col("n_name"))
    countries = nation.select(
        F.lit("i94cntyl").alias("list"),
        F.col("n_nationkey").cast("bigint").alias("k"),
        F.concat(F.lit("   "), F.col("n_nationkey").cast("string"), F.lit(" =  '"), marked, F.lit("'")).alias("line"),
    )
    number = F.col("s_suppkey").cast("string")
    ports = supplier.select(
        F.lit("$i94prtl").alias("list"),
        F.col("s_suppkey").cast("bigint").alias("k"),
        F.concat(F.lit("   'S"), number, F.lit("' = '"), "s_name", F.lit("''s   '")).alias("line"),
    )
    entries = F.array_sort(F.collect_list(F.struct("k", "line")))
    lists = countries.union(ports).groupBy("list").agg(entries.alias("entries"))
    body = F.array_join(F.transform("entries", lambda e: e["line"]), "\n")
    text = lists.select(F.concat(F.lit("  value "), "list", F.lit("\n"), body, F.lit("\n;")).alias("value"))
    text.coalesce(1).write.text(root)
    return read_codebook(spark, root)


@registered
def dropped_and_refilled(spark, sf_dir):
    """Rows per table of a filled mart, after dropping and creating it, and after filling it again."""
    job = _loaded_mart(spark, sf_dir)
    names = [FACT_TABLE, *DIMENSIONS]

    def counted(step: str) -> DataFrame:
        zeros = quality.literal_rows(spark, [{"name": F.lit(t), "one": F.lit(0)} for t in names])
        ones = [job.warehouse.read(t).select(F.lit(t).alias("name"), F.lit(1).alias("one")) for t in names]
        counts = reduce(DataFrame.unionAll, [zeros, *ones]).groupBy("name").agg(F.sum("one").alias("n"))
        rows = [{"step": F.lit(step), "name": F.lit(r.name), "n": F.lit(r.n).cast("bigint")} for r in counts.collect()]
        return quality.literal_rows(spark, rows)

    filled = counted("filled")
    jobs.set_up(job.warehouse, ad.port_source(spark, sf_dir), ad.carrier_source(spark, sf_dir), job.config)
    reset = counted("reset")
    jobs.load_batch(job.warehouse, _with_load_period(ad.arrivals(spark, sf_dir)), job.config)
    return filled.union(reset).union(counted("refilled"))


@registered
def refused_starts(spark, sf_dir):
    """Loads that cannot start: no file for the next month, no fact, an empty register, no register."""
    job = _loaded_mart(spark, sf_dir)
    warehouse = job.warehouse
    batch = _with_load_period(ad.arrivals(spark, sf_dir))

    def without(table: str, create: bool, start: Callable[[], object]) -> Callable[[], object]:
        def run() -> None:
            warehouse.drop([table])
            if create:
                warehouse.create([table])
            start()

        return run

    steps = {
        "no file": lambda: jobs.advance(job),
        "no fact": without(FACT_TABLE, False, lambda: jobs.load_batch(warehouse, batch, job.config)),
        "empty register": without("monthlytimes", True, lambda: jobs.next_period(warehouse)),
        "no register": without("monthlytimes", False, lambda: jobs.next_period(warehouse)),
    }
    rows = []
    for step, start in steps.items():
        try:
            start()
            outcome = "started"
        except (quality.QualityError, landing.SourceMissing) as error:
            outcome = str(error).rsplit("/", 1)[-1].split(":")[0]
        rows.append({"step": F.lit(step), "outcome": F.lit(outcome)})
    return quality.literal_rows(spark, rows)


@registered
def fact_from_lineitem(spark, sf_dir):
    """Fact rows of arrivals whose number repeats or is missing, some of unknown day and age."""
    arrivals = ad.line_arrivals(spark, sf_dir)
    return fact_plan.fact_rows(arrivals, ad.home_airports(spark, sf_dir), ad.ORDERS_CONFIG)


@registered
def keyless_lines(spark, sf_dir):
    """The source checks of those arrivals: rows without a number are left out and counted."""
    qualifies = filters.in_values("visatype", ad.ORDERS_CONFIG.visa_classes)
    return quality.source_checks(ad.line_arrivals(spark, sf_dir), qualifies)


@registered
def warehouse_loaded_fact(spark, sf_dir):
    """Load the arrivals before a year into a new warehouse, then deliver all of them again."""
    job = _prepared_mart(spark, sf_dir)
    delivered = _with_load_period(ad.arrivals(spark, sf_dir))
    earlier = delivered.filter(F.col("load_year") < SECOND_DELIVERY_YEAR)
    jobs.load_batch(job.warehouse, earlier, job.config)
    jobs.load_batch(job.warehouse, delivered, job.config)
    return job.warehouse.read(FACT_TABLE)
