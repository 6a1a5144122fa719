"""Kept roll-ups, compaction and rejected lines on small files."""

import pathlib

import pytest
from pyspark.sql import functions as F
from rows import ARRIVALS, HEADER, OTHER_PERIOD, csv_line
from test_jobs import Place, for_month

from starmart.plans import jobs, maintenance, marts, rollups
from starmart.schemas import FACT_TABLE, RAW_ARRIVALS
from starmart.sources import paths, publish, rejects


@pytest.fixture
def place(spark, tmp_path):
    place = Place(spark, tmp_path)
    place.deliver(2016, 1, ARRIVALS)
    place.bootstrap(2016, 1)
    return place


def add_month(place, month, numbers):
    place.deliver(2016, month, [for_month(OTHER_PERIOD, 2016, month, n) for n in numbers])
    jobs.advance(place.job)


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_rollups_follow_the_fact(place):
    warehouse = place.warehouse
    assert rollups.refresh(warehouse) == {(2016, 1)}
    assert rollups.refresh(warehouse) == set()
    add_month(place, 2, (13, 14))
    before = files_of(warehouse, rollups.TABLE, 1)
    assert rollups.refresh(warehouse) == {(2016, 2)}
    assert files_of(warehouse, rollups.TABLE, 1) == before
    place.deliver(2016, 2, [for_month(OTHER_PERIOD, 2016, 2, n) for n in (14, 15, 16)])
    jobs.restate_period(place.job, 2016, 2)
    assert rollups.refresh(warehouse) == {(2016, 2)}
    kept = rollups.attributes_over_time(warehouse).select("attribute", "value", "Year", "Month", "n")
    whole = marts.attributes_over_time(warehouse.read(FACT_TABLE)).select("attribute", "value", "Year", "Month", "n")
    assert rows_of(kept) == rows_of(whole)
    ages = rollups.attributes_over_time(warehouse).filter("attribute = 'Gender' AND value = 'F' AND Month IS NULL").first()
    assert (ages.n, ages.ages, ages.age_sum) == (5, 4, 25 + 3 * 26)
    paths.delete(place.job.spark, warehouse.period_path(2016, 2))
    rollups.refresh(warehouse)
    assert rollups.read(warehouse).filter("Month = 2").count() == 0


def test_sketches_of_months_make_those_of_years(place):
    add_month(place, 2, (13, 14))
    rollups.refresh(place.warehouse)
    found = {(r.field, r.Month): r.estimate for r in rollups.distinct_over_time(place.warehouse).collect()}
    for field in rollups.SKETCHED:
        fact = place.warehouse.read(FACT_TABLE)
        for month, rows in ((None, fact), (1, fact.filter("Month = 1")), (2, fact.filter("Month = 2"))):
            assert found[field, month] == rows.select(field).distinct().count()


def test_a_refresh_reads_the_changed_months_only(place):
    add_month(place, 2, (13, 14))
    plan = rollups.rows_of_months(place.warehouse, {(2016, 2)})._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert scans and all("(Month" in s and "= 2)" in s and "(Year" in s for s in scans)


def files_of(warehouse, table, month):
    folder = pathlib.Path(warehouse.path(table)) / "Year=2016" / f"Month={month}"
    return {f.name: f.read_bytes() for f in folder.glob("*.parquet")}


def batches(place, n):
    schema = "cicid double, i94yr double, i94mon double, i94port string, arrdate double, biryear double, " \
        "gender string, airline string, admnum string, fltno string, visatype string"  # fmt: skip
    for k in range(n):
        rows = [for_month(OTHER_PERIOD, 2016, 2, 100 * k + i) for i in range(100, 140)]
        frame = place.job.spark.createDataFrame(rows, schema)
        jobs.load_batch(place.warehouse, frame.withColumns({"load_year": F.lit(2016), "load_month": F.lit(2)}), place.job.config)


def test_compaction(place, monkeypatch):
    batches(place, 3)
    warehouse = place.warehouse
    before, january = rows_of(warehouse.read(FACT_TABLE)), files_of(warehouse, FACT_TABLE, 1)
    size = sum(len(b) for b in files_of(warehouse, FACT_TABLE, 2).values())
    assert len(files_of(warehouse, FACT_TABLE, 2)) == 3 and len(january) == 1
    assert maintenance.compact(warehouse, file_bytes=size // 2 + 1) == {(2016, 2)}
    assert len(files_of(warehouse, FACT_TABLE, 2)) == 2
    assert maintenance.compact(warehouse) == {(2016, 2)}
    assert len(files_of(warehouse, FACT_TABLE, 2)) == 1
    assert maintenance.compact(warehouse) == set()
    assert rows_of(warehouse.read(FACT_TABLE)) == before and files_of(warehouse, FACT_TABLE, 1) == january


@pytest.mark.parametrize("stop", ["delete", "move"])
def test_a_stopped_compaction_loses_and_doubles_nothing(place, monkeypatch, stop):
    batches(place, 2)
    before = rows_of(place.warehouse.read(FACT_TABLE))
    plain = getattr(paths, stop)

    def stopping(spark, *where):
        if FACT_TABLE in where[-1]:
            raise RuntimeError("stopped")
        return plain(spark, *where)

    with monkeypatch.context() as patch:
        patch.setattr(paths, stop, stopping)
        with pytest.raises(RuntimeError):
            maintenance.compact(place.warehouse)
    place.warehouse.finish()
    assert rows_of(place.warehouse.read(FACT_TABLE)) == before
    assert not [n for n in paths.names_in(place.job.spark, f"{place.warehouse.root}/_changes") if n.endswith(publish.OPEN)]


def test_rejected_lines(spark, tmp_path):
    """Lines are numbered over the splits of a file; a file with another header is rejected line by line."""
    good = [csv_line(for_month(ARRIVALS[0], 2016, 1, n)) for n in range(400)]
    lines = [HEADER, *good]
    for at in (1, 7, 250, 400):
        lines[at] = lines[at].replace("2016.0", "twenty")
    lines[300] = ""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "F_1_2016.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "in" / "F_2_2016.csv").write_text("\n".join(["a,b", good[0], "x"]) + "\n")
    (tmp_path / "in" / "F_3_2016.csv").write_text("")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        rejects.load_lines(spark, [str(tmp_path / "in")], str(tmp_path / "good"), str(tmp_path / "bad"), str(tmp_path / "lines"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert spark.read.parquet(str(tmp_path / "lines")).select("split").distinct().count() > 3
    bad = {(r.file[-12:], r.line): (r.reason, r.text) for r in spark.read.parquet(str(tmp_path / "bad")).collect()}
    expected = {("F_1_2016.csv", at + 1): ("values", lines[at]) for at in (1, 7, 250, 400)}
    expected |= {("F_2_2016.csv", 2): ("header", good[0]), ("F_2_2016.csv", 3): ("header", "x")}
    assert bad == expected
    kept = spark.read.schema(RAW_ARRIVALS).parquet(str(tmp_path / "good"))
    assert sorted(r.cicid for r in kept.select("cicid").collect()) == [float(n) for n in range(400) if n not in (0, 6, 249, 299, 399)]
