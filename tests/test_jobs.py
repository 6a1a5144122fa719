import pathlib

import pytest
from pyspark.sql import functions as F
from rows import (
    AIRLINE_FILE,
    AIRLINES,
    AIRPORT_FILE,
    ARRIVALS,
    HOME,
    KEPT_IDS,
    OTHER_PERIOD,
    WITHOUT_KEY,
    schema_of_kept,
    write_raw,
)

from starmart.__main__ import main
from starmart.config import MartConfig
from starmart.plans import fact as fact_plan
from starmart.operators.insert import absent_rows
from starmart.plans import jobs, marts, quality
from starmart.schemas import DIMENSIONS, FACT_COLUMNS, FACT_TABLE, TABLES
from starmart.sources import keys as keys_module
from starmart.sources import paths, publish
from starmart.sources.landing import SourceMissing
from starmart.sources.raw import raw_file_name
from starmart.sources.warehouse import Warehouse
from starmart.streaming.arrivals import deliveries, load_arriving


@pytest.fixture
def airports(spark, tmp_path):
    """A stored table, so Spark knows its size."""
    path = str(tmp_path / "airports")
    spark.createDataFrame(HOME, TABLES["airports"]).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def fact(spark, airports):
    arrivals = spark.createDataFrame(ARRIVALS, schema_of_kept())
    return fact_plan.fact_rows(arrivals, airports, MartConfig())


class Place:
    """A mart in a test folder."""

    def __init__(self, spark, root):
        self.incoming = root / "incoming"
        self.incoming.mkdir()
        self.airports = root / "airports.csv"
        self.airports.write_text(AIRPORT_FILE)
        self.airlines = root / "airlines.json"
        self.airlines.write_text(AIRLINE_FILE)
        self.warehouse = Warehouse(spark, str(root / "warehouse"))
        self.landed = str(root / "landed")
        self.job = jobs.MartJob(spark, str(self.incoming), self.landed, self.warehouse)

    def deliver(self, year, month, rows):
        write_raw(self.incoming / raw_file_name(year, month), rows)

    def bootstrap(self, year, month):
        return jobs.bootstrap(self.job, str(self.airports), str(self.airlines), year, month)

    def fact_ids(self):
        return sorted(r.CICID for r in self.warehouse.read(FACT_TABLE).select("CICID").collect())


@pytest.fixture
def place(spark, tmp_path):
    return Place(spark, tmp_path)


def for_month(row, year, month, number):
    return (float(number), float(year), float(month), *row[3:])


def test_fact_rows(fact):
    assert tuple(fact.columns) == FACT_COLUMNS
    assert fact.dtypes == [(f.name, f.dataType.simpleString()) for f in TABLES[FACT_TABLE].fields]
    found = {r.CICID: r for r in fact.collect()}
    assert sorted(found) == KEPT_IDS
    first = found["1"]
    assert (first.Day, first.Age, first.Age_Group, first.Adm_Number) == (1, 25, 1, "92478490733")
    assert (first.Monthly_Time, first.Flight_Number) == ("1_2016", "00123")
    second = found["2"]
    assert (second.Day, second.Gender, second.Airline_Code, second.Adm_Number) == (31, "U", "Unknown", "123")
    assert (second.Airport_Code, second.Airport_Municipality) == ("SAV", "Savannah")
    assert [found[i].Age_Group for i in ("3", "4", "5", "6", "7", "8")] == [2, 3, 3, 4, 4, 5]
    assert (found["12"].Day, found["12"].Age, found["12"].Age_Group) == (None, None, None)
    assert found["3"].Adm_Number == ""


def test_filters_come_before_the_shuffle(fact):
    plan = fact._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 1
    assert "WindowGroupLimit" in plan.split("Exchange hashpartitioning")[1]
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan


def test_reports(spark, fact, airports):
    airlines = spark.createDataFrame(AIRLINES, TABLES["airlines"])
    groups = spark.createDataFrame([(1, "young"), (2, "older")], TABLES["agegroups"])
    assert [tuple(r) for r in marts.by_visa_type(fact).collect()] == [("E1", 2), ("E2", 1), ("E3", 6)]
    assert [tuple(r) for r in marts.by_age_group(fact, groups).collect()] == [
        (1, "young", 1),
        (2, "older", 2),
    ]
    assert {tuple(r) for r in marts.by_gender(fact).collect()} == {("F", 2), ("U", 1), ("M", 5), ("X", 1)}
    assert [tuple(r) for r in marts.by_month(fact, 2016).collect()] == [("1_2016", 9)]
    assert marts.by_month(fact, 2015).count() == 0
    assert {tuple(r) for r in marts.by_municipality(fact).collect()} == {("Atlanta", 8), ("Savannah", 1)}
    ages = marts.average_ages(fact, 2, "F").first()
    assert ages.avg_age_in_group == 30.5 and ages.avg_age_in_group_rounded == 30
    assert ages.avg_age_of_gender == 25.0
    flights = marts.flights_with_airline(fact, airlines, 2).collect()
    assert [(r.CICID, r.airline_name) for r in flights] == [("1", "Delta"), ("12", "Delta")]
    joined = marts.arrivals_with_airport(fact, airports)
    assert joined.columns == [*FACT_COLUMNS, "airport_type", "name", "municipality"]
    assert joined.count() == 5
    assert fact_plan.with_airline(fact, airlines).filter("airline_name is null").count() == 2
    points = {(r.chart, r.label): r.n for r in marts.chart_points(fact).collect()}
    assert points[("Gender", "F")] == 2 and points[("Age_Group", None)] == 1
    for attribute in marts.REPORT_ATTRIBUTES:
        assert marts.over_time(fact, attribute).filter("level = 0").first().n == 9


def test_month_order(spark):
    data = [(2016, m, f"{m}_2016") for m in (1, 2, 10, 12)]
    frame = spark.createDataFrame(data, "Year int, Month int, Monthly_Time string")
    assert [r[0] for r in marts.by_month(frame, 2016).collect()] == ["1_2016", "2_2016", "10_2016", "12_2016"]
    assert [r[0] for r in marts.by_month(frame, 2016, text_order=True).collect()] == [
        "10_2016",
        "12_2016",
        "1_2016",
        "2_2016",
    ]


def outcomes(report):
    return {r.check_name: (r.passed, r.observed) for r in report.collect()}


def test_batch_checks(spark, fact, airports):
    batch = fact.withColumns({"load_year": F.lit(2016), "load_month": F.lit(1)})
    found = outcomes(quality.batch_checks(batch))
    assert found["batch_not_empty"] == (True, 9)
    assert found["period_matches"] == (True, 0)
    assert found["fact_column_count"] == (True, 14)
    assert all(passed for passed, _ in found.values())
    wrong = outcomes(quality.batch_checks(batch.withColumn("load_month", F.lit(2))))
    assert wrong["period_matches"] == (False, 9)
    unknown = outcomes(quality.batch_checks(batch.withColumn("load_month", F.lit(None).cast("int"))))
    assert unknown["period_matches"] == (False, 9)
    thirteenth = batch.withColumns({"Month": F.lit(13), "load_month": F.lit(13)})
    assert outcomes(quality.batch_checks(thirteenth))["period_matches"] == (False, 9)
    hollow = batch.withColumns({"Day": F.lit(None).cast("int"), "Age": F.lit(200)})
    found = outcomes(quality.batch_checks(hollow))
    assert found["no_empty_column"] == (False, 1)
    assert found["age_in_range"] == (False, 9)
    assert outcomes(quality.batch_checks(batch.limit(0)))["batch_not_empty"] == (False, 0)
    extra = outcomes(quality.batch_checks(batch.withColumn("more", F.lit(1))))
    assert extra["fact_column_count"] == (False, 15)


def test_a_period_of_a_batch_without_rows_is_found(spark):
    delivered = {(2016, 1), (2016, 2), (None, None)}
    found = outcomes(quality.period_check(spark, delivered, {(2016, 1)}))
    assert found == {"every_period_has_rows": (False, 2)}
    found = outcomes(quality.period_check(spark, {(2016, 1)}, {(2016, 1)}))
    assert found == {"every_period_has_rows": (True, 0)}


def test_batch_and_key_checks_in_one_pass(fact):
    batch = fact.withColumns({"load_year": F.lit(2016), "load_month": F.lit(1)})
    for rows in (batch, batch.union(batch), batch.limit(0)):
        apart = outcomes(quality.batch_checks(rows)) | outcomes(quality.key_checks(rows))
        assert outcomes(quality.batch_and_key_checks(rows)) == apart


def test_numbers_stored_alike_are_one_arrival(spark, airports):
    rows = [for_month(ARRIVALS[0], 2016, 1, n) for n in ("1.0", "1.25", "nan")]
    batch = fact_plan.fact_rows(spark.createDataFrame(rows, schema_of_kept()), airports, MartConfig())
    assert [r.CICID for r in batch.collect()] == ["1"]


def test_key_and_source_checks(spark, fact):
    assert outcomes(quality.key_checks(fact)) == {"key_unique": (True, 0)}
    assert outcomes(quality.key_checks(fact.union(fact))) == {"key_unique": (False, 9)}
    arrivals = spark.createDataFrame([*ARRIVALS, WITHOUT_KEY], schema_of_kept())
    found = outcomes(quality.source_checks(arrivals, F.col("visatype") == "E1"))
    assert found == {
        "source_has_rows": (True, 14),
        "arrival_number_present": (False, 1),
        "corrupt_rows": (True, 0),
    }
    assert outcomes(quality.source_checks(arrivals.limit(0), F.lit(True)))["source_has_rows"] == (False, 0)


def test_missing_and_empty_dimensions_are_told_apart(spark, airports):
    report = quality.dimension_checks(
        spark, {"airports": airports, "airlines": None, "years": airports.limit(0)}
    )
    assert outcomes(report) == {
        "airports_has_rows": (True, 2),
        "airlines_exists": (False, 0),
        "years_has_rows": (False, 0),
    }
    with pytest.raises(quality.QualityError, match="airlines_exists.*years_has_rows"):
        quality.enforce(report)


def test_warnings_do_not_stop_a_load(spark, caplog):
    quality.enforce(quality.growth_check(spark, 0, 0))
    assert "fact_grew: 0, expected > 0" in caplog.text
    quality.enforce(quality.growth_check(spark, 3, 0))
    with pytest.raises(quality.QualityError, match="fact_grew"):
        quality.enforce(quality.growth_check(spark, 3, 1))


def test_create_and_drop(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    assert not warehouse.exists(FACT_TABLE)
    warehouse.create()
    for table, schema in TABLES.items():
        assert warehouse.read(table).schema == schema
        assert warehouse.count(table) == 0
    warehouse.insert_if_absent("years", spark.createDataFrame([(2016,), (2016,)], "year int"))
    warehouse.create()
    assert warehouse.count("years") == 1
    warehouse.drop()
    warehouse.drop()
    assert not any(warehouse.exists(table) for table in TABLES)


def test_bootstrap_and_following_months(place):
    place.deliver(2016, 12, [for_month(r, 2016, 12, r[0]) for r in ARRIVALS])
    assert place.bootstrap(2016, 12) == 9
    assert place.fact_ids() == KEPT_IDS
    for table in DIMENSIONS:
        assert place.warehouse.count(table) > 0
    assert jobs.registered_period(place.warehouse) == (2016, 12)
    assert jobs.next_period(place.warehouse) == (2017, 1)

    with pytest.raises(SourceMissing):
        jobs.advance(place.job)
    assert jobs.registered_period(place.warehouse) == (2016, 12)

    # Number 5 is already there and keeps its first row.
    late = [for_month(ARRIVALS[0], 2017, 1, n) for n in (5, 50, 51)]
    place.deliver(2017, 1, late)
    assert jobs.advance(place.job) == (2017, 1, 2)
    assert place.fact_ids() == sorted([*KEPT_IDS, "50", "51"])
    kept_first = place.warehouse.read(FACT_TABLE).filter("CICID = '5'").first()
    assert (kept_first.Year, kept_first.Month) == (2016, 12)
    assert jobs.registered_period(place.warehouse) == (2017, 1)


def test_loading_a_period_again_adds_nothing(place):
    place.deliver(2016, 1, ARRIVALS)
    place.bootstrap(2016, 1)
    assert jobs.load_period(place.job, 2016, 1) == 0
    assert place.fact_ids() == KEPT_IDS
    assert place.warehouse.count("monthlytimes") == 1


def test_a_failed_check_publishes_nothing(place):
    place.deliver(2016, 1, ARRIVALS)
    place.bootstrap(2016, 1)
    place.deliver(2016, 2, [OTHER_PERIOD, for_month(OTHER_PERIOD, 2016, 3, 14)])
    with pytest.raises(quality.QualityError, match="period_matches"):
        jobs.advance(place.job)
    assert place.fact_ids() == KEPT_IDS
    assert jobs.registered_period(place.warehouse) == (2016, 1)
    assert place.warehouse.count("months") == 1


def test_a_corrected_file_loads_when_forced(place):
    place.deliver(2016, 1, ARRIVALS)
    place.bootstrap(2016, 1)
    place.deliver(2016, 2, [OTHER_PERIOD, for_month(OTHER_PERIOD, 2016, 3, 14)])
    with pytest.raises(quality.QualityError, match="period_matches"):
        jobs.advance(place.job)
    place.deliver(2016, 2, [OTHER_PERIOD])
    with pytest.raises(quality.QualityError, match="period_matches"):
        jobs.advance(place.job)
    assert jobs.advance(place.job, force=True) == (2016, 2, 1)


def test_a_new_period_that_adds_nothing_fails(spark, place):
    """Also next to a known period that may, in one batch."""
    place.deliver(2016, 1, ARRIVALS)
    place.bootstrap(2016, 1)
    known = [for_month(ARRIVALS[0], 2016, 1, 60), for_month(OTHER_PERIOD, 2016, 2, 1)]
    batch = spark.createDataFrame(known, schema_of_kept()).withColumns(
        {"load_year": F.lit(2016), "load_month": F.col("i94mon").cast("int")}
    )
    with pytest.raises(quality.QualityError, match="fact_grew"):
        jobs.load_batch(place.warehouse, batch, place.job.config)


def test_corrupt_rows_are_counted(place, caplog):
    place.deliver(2016, 1, [*ARRIVALS, ("x", *ARRIVALS[0][1:])])
    place.bootstrap(2016, 1)
    assert "corrupt_rows: 1" in caplog.text


def test_a_load_leaves_no_scratch(place):
    place.deliver(2016, 1, ARRIVALS)
    place.bootstrap(2016, 1)
    root = pathlib.Path(place.warehouse.root) / "_scratch"
    assert not root.exists() or not any(root.iterdir())


def test_a_month_without_qualifying_rows_fails(place):
    place.deliver(2016, 1, ARRIVALS)
    place.bootstrap(2016, 1)
    place.deliver(2016, 2, [(*OTHER_PERIOD[:-1], "B2")])
    with pytest.raises(quality.QualityError, match="batch_not_empty"):
        jobs.advance(place.job)
    place.deliver(2016, 2, [])
    landed_again = jobs.landing.land(
        place.job.spark, str(place.incoming), place.landed, 2016, 2, force=True
    )
    assert landed_again["rows"] == 0
    with pytest.raises(quality.QualityError, match="source_has_rows"):
        jobs.advance(place.job)


@pytest.mark.parametrize("moves", range(6))
def test_a_stopped_publication_is_finished(place, monkeypatch, moves):
    """Whichever file it stopped at: fact, keys, year, month, register or the plan itself."""
    place.deliver(2016, 12, [for_month(r, 2016, 12, r[0]) for r in ARRIVALS])
    place.bootstrap(2016, 12)
    place.deliver(2017, 1, [for_month(OTHER_PERIOD, 2017, 1, 13)])
    plain, done = paths.move, []

    def stopping(spark, source, target):
        if "_changes" not in target or target.endswith(publish.DONE):
            if len(done) == moves:
                raise RuntimeError("stopped")
            done.append(target)
        plain(spark, source, target)

    with monkeypatch.context() as patch:
        patch.setattr(paths, "move", stopping)
        with pytest.raises(RuntimeError):
            jobs.advance(place.job)
    assert jobs.registered_period(place.warehouse) == (2017, 1)
    assert place.fact_ids() == sorted([*KEPT_IDS, "13"])
    known = place.warehouse.keys().known().collect()
    assert sorted(r.CICID for r in known) == place.fact_ids()
    assert jobs.load_period(place.job, 2017, 1) == 0
    assert [place.warehouse.count(t) for t in ("years", "months", "monthlytimes")] == [2, 2, 2]


def test_a_refused_batch_leaves_the_fact(spark, place):
    """Two new months, of which one only has a known number: none is loaded, the corrected ones are."""
    place.deliver(2016, 1, ARRIVALS)
    place.bootstrap(2016, 1)

    def batch(*rows):
        frame = spark.createDataFrame([for_month(ARRIVALS[0], *r) for r in rows], schema_of_kept())
        return frame.withColumns({"load_year": F.lit(2016), "load_month": F.col("i94mon").cast("int")})

    for _ in range(2):
        with pytest.raises(quality.QualityError, match="fact_grew"):
            jobs.load_batch(place.warehouse, batch((2016, 2, 1), (2016, 3, 70)), place.job.config)
        assert place.fact_ids() == KEPT_IDS
        assert place.warehouse.count("monthlytimes") == place.warehouse.count("months") == 1
        assert place.warehouse.keys().known().count() == len(KEPT_IDS)
    assert not any((pathlib.Path(place.warehouse.root) / "_scratch").iterdir())
    assert jobs.load_batch(place.warehouse, batch((2016, 2, 71), (2016, 3, 70)), place.job.config) == 2
    assert jobs.registered_period(place.warehouse) == (2016, 3)


def test_the_history_of_keys_is_not_shuffled(spark, place, monkeypatch):
    """Neither to find a key's state nor to join a batch beyond the broadcast bound with it."""
    place.deliver(2016, 1, ARRIVALS)
    place.bootstrap(2016, 1)
    monkeypatch.setattr(keys_module, "fits_broadcast", lambda side: False)
    batch = spark.createDataFrame([(str(i),) for i in range(5, 30)], "CICID string")
    keys = place.warehouse.keys()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = absent_rows(batch, keys.known(among=batch), "CICID", unique=True)
        assert sorted(int(r.CICID) for r in new.collect()) == [i for i in range(5, 30) if i not in (5, 6, 7, 8, 12)]
        plan = new._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan = next(i for i, line in enumerate(plan.splitlines()) if "Scan parquet" in line)
    above = [line for line in plan.splitlines()[: scan + 1]]
    indent = len(above[scan].split("Scan")[0])
    shuffled = [line for line in above if "Exchange" in line]
    assert f"SelectedBucketsCount: {keys.buckets} out of {keys.buckets}" in plan
    assert len(shuffled) == 1 and shuffled[0].index("Exchange") < indent
    history = plan[plan.index("SortAggregate") if "SortAggregate" in plan else plan.index("HashAggregate") :]
    assert "Exchange" not in history.split("Scan parquet")[0]


def test_keys_of_an_older_warehouse(place):
    """A fact that was loaded before there was a log gets one."""
    place.deliver(2016, 1, ARRIVALS)
    place.bootstrap(2016, 1)
    place.warehouse.keys().drop()
    place.deliver(2016, 2, [OTHER_PERIOD, for_month(OTHER_PERIOD, 2016, 2, 5)])
    assert jobs.advance(place.job) == (2016, 2, 1)
    assert place.warehouse.keys().known().count() == len(KEPT_IDS) + 1


def files_of(place, year, month):
    folder = pathlib.Path(place.warehouse.period_path(year, month))
    return {f.name: f.read_bytes() for f in folder.glob("*.parquet")}


def test_restating_a_month(place):
    """The corrected file takes the month's place; numbers it no longer has may come with a later month."""
    place.deliver(2016, 1, ARRIVALS)
    place.bootstrap(2016, 1)
    place.deliver(2016, 2, [for_month(OTHER_PERIOD, 2016, 2, n) for n in (13, 14, 15)])
    jobs.advance(place.job)
    others = files_of(place, 2016, 1)
    changed = [(*for_month(OTHER_PERIOD, 2016, 2, n)[:6], "X", *OTHER_PERIOD[7:]) for n in (14, 16, 1)]
    place.deliver(2016, 2, changed)
    assert jobs.restate_period(place.job, 2016, 2) == 2
    fact = {r.CICID: (r.Month, r.Gender) for r in place.warehouse.read(FACT_TABLE).collect()}
    assert {k: v for k, v in fact.items() if v[0] == 2} == {"14": (2, "X"), "16": (2, "X")}
    assert fact["1"] == (1, "F") and len(fact) == len(KEPT_IDS) + 2
    assert files_of(place, 2016, 1) == others
    place.deliver(2016, 3, [for_month(OTHER_PERIOD, 2016, 3, n) for n in (13, 14, 15, 16)])
    assert jobs.advance(place.job) == (2016, 3, 2)
    with pytest.raises(quality.QualityError, match="4_2016 is not loaded"):
        jobs.restate_period(place.job, 2016, 4)


def test_a_refused_restatement_leaves_the_month(place):
    place.deliver(2016, 1, ARRIVALS)
    place.bootstrap(2016, 1)
    before = files_of(place, 2016, 1)
    place.deliver(2016, 1, [OTHER_PERIOD])
    with pytest.raises(quality.QualityError, match="period_matches"):
        jobs.restate_period(place.job, 2016, 1)
    assert files_of(place, 2016, 1) == before and place.warehouse.keys().known().count() == len(KEPT_IDS)


def test_register_has_to_exist_and_have_rows(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    with pytest.raises(quality.QualityError, match="does not exist"):
        jobs.registered_period(warehouse)
    warehouse.create()
    with pytest.raises(quality.QualityError, match="no rows"):
        jobs.registered_period(warehouse)


def test_missing_fact_table_stops_the_load(place):
    place.deliver(2016, 1, ARRIVALS)
    place.bootstrap(2016, 1)
    place.warehouse.drop([FACT_TABLE])
    with pytest.raises(quality.QualityError, match="fact_exists"):
        jobs.load_period(place.job, 2016, 1)


def test_sql_over_the_warehouse(spark, place):
    place.deliver(2016, 1, ARRIVALS)
    place.bootstrap(2016, 1)
    place.warehouse.register_views()
    counted = spark.sql(
        "SELECT Gender, COUNT(*) AS n FROM immigrationfacts WHERE Year = :year GROUP BY Gender",
        args={"year": 2016},
    )
    assert {tuple(r) for r in counted.collect()} == {("F", 2), ("U", 1), ("M", 5), ("X", 1)}


def test_reading_a_period_prunes_the_others(place):
    place.deliver(2016, 1, ARRIVALS)
    place.bootstrap(2016, 1)
    frame = place.warehouse.read(FACT_TABLE).filter("Year = 2016 AND Month = 1").select("Age")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Year" in plan
    assert "ReadSchema: struct<Age:int>" in plan


def arrive(place, checkpoint):
    query = load_arriving(place.job, str(checkpoint))
    assert query.awaitTermination(300)
    if query.exception():
        raise query.exception()
    return {(r.year, r.month): (r.state, r.reason) for r in deliveries(place.warehouse).collect()}


def parts_of(place, year, month):
    folder = place.incoming / raw_file_name(year, month)
    folder.mkdir()
    return folder


def test_arriving_files(place, tmp_path):
    place.deliver(2016, 1, ARRIVALS)
    place.bootstrap(2016, 1)
    assert arrive(place, tmp_path / "checkpoint") == {(2016, 1): ("loaded", None)}
    assert place.fact_ids() == KEPT_IDS
    folder = parts_of(place, 2016, 2)
    write_raw(folder / "part-0.csv", [OTHER_PERIOD])
    write_raw(folder / "part-1.csv", [for_month(OTHER_PERIOD, 2016, 2, 14)])
    (folder / "_SUCCESS").touch()
    place.deliver(2016, 3, [for_month(OTHER_PERIOD, 2016, 3, n) for n in (14, 15)])
    arrive(place, tmp_path / "checkpoint")
    arrive(place, tmp_path / "checkpoint")
    assert place.fact_ids() == sorted([*KEPT_IDS, "13", "14", "15"])
    assert jobs.registered_period(place.warehouse) == (2016, 3)
    first = place.warehouse.read(FACT_TABLE).filter("CICID = '14'").first()
    assert first.Month == 2


def test_bad_files_do_not_hold_up_others(place, tmp_path):
    """Of a month of other rows, one without header, one without new rows and one not whole, each is put aside
    or waits; a corrected file of the same name loads with the next run."""
    checkpoint = tmp_path / "checkpoint"
    place.deliver(2016, 1, ARRIVALS)
    place.bootstrap(2016, 1)
    place.deliver(2016, 2, [OTHER_PERIOD, for_month(OTHER_PERIOD, 2016, 9, 30)])
    (place.incoming / raw_file_name(2016, 3)).write_text("a,b\n1,2\n")
    place.deliver(2016, 4, [for_month(OTHER_PERIOD, 2016, 4, 1)])
    place.deliver(2016, 5, [for_month(OTHER_PERIOD, 2016, 5, n) for n in (13, 50)])
    late = parts_of(place, 2016, 6)
    write_raw(late / "part-0.csv", [for_month(OTHER_PERIOD, 2016, 6, 60)])
    (place.incoming / "F_13_2016.csv").write_text("a,b\n1,2\n")
    found = arrive(place, checkpoint)
    assert {p: state for p, (state, _) in found.items()} == {
        (2016, 1): "loaded", (2016, 2): "refused", (2016, 3): "refused", (2016, 4): "refused",
        (2016, 5): "loaded", (2016, 6): "waiting", (2016, 13): "refused",
    }
    assert "period_matches: 1" in found[2016, 2][1] and "fact_grew" in found[2016, 4][1]
    assert place.fact_ids() == sorted([*KEPT_IDS, "13", "50"])
    left = {f.name for f in place.incoming.iterdir()}
    assert {raw_file_name(2016, 5), raw_file_name(2016, 6)} <= left
    assert not {raw_file_name(2016, m) for m in (2, 3, 4)} & left
    assert len(list((place.incoming / "_refused").iterdir())) == 4

    place.deliver(2016, 2, [for_month(OTHER_PERIOD, 2016, 2, 31)])
    (late / "_SUCCESS").touch()
    found = arrive(place, checkpoint)
    assert found[2016, 2][0] == found[2016, 6][0] == "loaded" and found[2016, 3][0] == "refused"
    assert place.fact_ids() == sorted([*KEPT_IDS, "13", "31", "50", "60"])
    assert place.warehouse.count("monthlytimes") == 4


def test_command_line(spark, place, capsys, tmp_path):
    place.deliver(2016, 1, ARRIVALS)
    place.deliver(2016, 2, [OTHER_PERIOD])
    folders = [
        "--incoming", str(place.incoming), "--landed", place.landed,
        "--warehouse", place.warehouse.root,
    ]
    first = ["bootstrap", "--airports", str(place.airports), "--airlines", str(place.airlines)]
    main([*folders, *first, "--year", "2016", "--month", "1"])
    main([*folders, "advance"])
    assert capsys.readouterr().out.splitlines()[-2:] == ["1_2016: 9 new rows", "2_2016: 1 new rows"]
