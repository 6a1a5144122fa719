import math
import pytest
from pyspark.sql import functions as F
from rows import AIRLINE_FILE, AIRPORT_FILE, ARRIVALS, HEADER, write_raw

from starmart.schemas import RAW_ARRIVALS
from starmart.session import scratch_path, size_shuffles
from starmart.sources import landing, paths
from starmart.sources.codebook import read_codebook
from starmart.sources.dimension_files import read_airlines, read_airports
from starmart.sources.raw import CORRUPT, file_period, kept, raw_file_name, read_raw


def test_raw_file_is_read_by_declared_schema(spark, tmp_path):
    path = write_raw(tmp_path / raw_file_name(2016, 1), ARRIVALS)
    frame = read_raw(spark, path)
    assert frame.drop(CORRUPT).schema == RAW_ARRIVALS
    assert sorted(map(repr, map(tuple, kept(frame).collect()))) == sorted(
        repr(tuple(r)) for r in ARRIVALS
    )
    period = frame.select(*file_period()).distinct().collect()
    assert [tuple(p) for p in period] == [(2016, 1)]


def test_raw_value_of_the_wrong_type_becomes_null_and_is_counted(spark, tmp_path):
    broken = ("abc", *ARRIVALS[1][1:])
    write_raw(tmp_path / raw_file_name(2016, 1), [ARRIVALS[0], broken])
    seen = landing.land(spark, str(tmp_path), str(tmp_path / "landed"), 2016, 1)
    assert seen == {"rows": 2, "corrupt": 1}
    landed = landing.read_landed(spark, str(tmp_path / "landed"), 2016, 1)
    assert landed.filter("cicid is null").count() == 1


def test_raw_file_with_another_header_fails(spark, tmp_path):
    names = HEADER.split(",")
    swapped = ",".join([names[1], names[0], *names[2:]])
    write_raw(tmp_path / raw_file_name(2016, 1), ARRIVALS, swapped)
    with pytest.raises(Exception, match="header"):
        landing.land(spark, str(tmp_path), str(tmp_path / "landed"), 2016, 1)
    assert not paths.is_complete(spark, landing.landed_path(str(tmp_path / "landed"), 2016, 1))


def test_landing_happens_once(spark, tmp_path):
    incoming, landed = str(tmp_path), str(tmp_path / "landed")
    with pytest.raises(landing.SourceMissing):
        landing.land(spark, incoming, landed, 2016, 1)
    write_raw(tmp_path / raw_file_name(2016, 1), ARRIVALS)
    assert landing.land(spark, incoming, landed, 2016, 1)["rows"] == len(ARRIVALS)
    write_raw(tmp_path / raw_file_name(2016, 1), ARRIVALS[:2])
    assert landing.land(spark, incoming, landed, 2016, 1) is None
    assert landing.read_landed(spark, landed, 2016, 1).count() == len(ARRIVALS)
    assert landing.land(spark, incoming, landed, 2016, 1, force=True)["rows"] == 2
    assert landing.read_landed(spark, landed, 2016, 1).count() == 2


def test_unfinished_landing_is_written_again(spark, tmp_path):
    target = tmp_path / "landed" / "year=2016" / "month=1"
    target.mkdir(parents=True)
    write_raw(tmp_path / raw_file_name(2016, 1), ARRIVALS[:3])
    assert landing.land(spark, str(tmp_path), str(tmp_path / "landed"), 2016, 1)["rows"] == 3


def test_scan_reads_only_needed_columns(spark, tmp_path):
    write_raw(tmp_path / raw_file_name(2016, 1), ARRIVALS)
    landing.land(spark, str(tmp_path), str(tmp_path / "landed"), 2016, 1)
    frame = landing.read_landed(spark, str(tmp_path / "landed"), 2016, 1)
    plan = frame.filter(F.col("visatype") == "E1").select("cicid")._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "ReadSchema: struct<cicid:double,visatype:string>" in text
    assert "EqualTo(visatype,E1)" in text


def test_dimension_files(spark, tmp_path):
    (tmp_path / "airports.csv").write_text(AIRPORT_FILE)
    (tmp_path / "airlines.json").write_text(AIRLINE_FILE)
    airports = read_airports(spark, str(tmp_path / "airports.csv"))
    assert airports.columns == ["name", "type", "municipality", "local_code", "iso_region"]
    assert airports.count() == 6
    assert airports.filter("local_code is null").count() == 1
    assert airports.filter("name = 'Sea, by the'").count() == 1
    airlines = read_airlines(spark, str(tmp_path / "airlines.json"))
    assert airlines.count() == 7
    assert airlines.columns == ["iata", "name", "country", "active"]


CODES = """\
libname library 'somewhere' ;
proc format library=library ;

/* a comment with 'quotes' and a value = 'x' */
  value i94cntyl
   582 =  'FIRST LAND (with, punctuation)'
     0  =  'INVALID: NO LAND'
   311 =  'Collapsed land'
   996 =  'No Country Code (996)' ;


/* next */
  value $i94prtl
   'ALC'\t=\t'AL; CAN, AK             '
   'INT'\t=\t'INT''L FALLS, MN      '
   'CP '\t=\t'No PORT Code (CP)'
   'NK' \t=\t'A PORT  '
;
value i94model
\t1 = 'Air'
\t9 = 'Not reported' ;
\t
value i94addrl
\t'AL'='ALABAMA'
\t'99'='All Other Codes' ;

run ;
"""


def test_codebook(spark, tmp_path):
    path = tmp_path / "codes.sas"
    path.write_text(CODES)
    found = {(r.domain, r.code, r.label, r.code_class) for r in read_codebook(spark, str(path)).collect()}
    assert found == {
        ("country", "582", "FIRST LAND (with, punctuation)", "valid"),
        ("country", "0", "INVALID: NO LAND", "invalid"),
        ("country", "311", "Collapsed land", "collapsed"),
        ("country", "996", "No Country Code (996)", "no_code"),
        ("port", "ALC", "AL; CAN, AK", "valid"),
        ("port", "INT", "INT'L FALLS, MN", "valid"),
        ("port", "CP", "No PORT Code (CP)", "no_code"),
        ("port", "NK", "A PORT", "valid"),
        ("mode", "1", "Air", "valid"),
        ("mode", "9", "Not reported", "valid"),
        ("state", "AL", "ALABAMA", "valid"),
        ("state", "99", "All Other Codes", "valid"),
        ("visa_category", "1", "Business", "valid"),
        ("visa_category", "2", "Pleasure", "valid"),
        ("visa_category", "3", "Student", "valid"),
    }


def test_scratch_path_follows_the_session(spark):
    class Given:
        conf = {"spark.checkpoint.dir": "/shared/folder/"}

    first, second = scratch_path(Given, "x"), scratch_path(Given, "x")
    assert first.startswith("/shared/folder/x-") and first != second
    own = scratch_path(spark, "x")
    assert scratch_path(spark, "x").rsplit("/", 1)[0] == own.rsplit("/", 1)[0]


def test_shuffles_grow_with_the_input(spark):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        size_shuffles(spark, 1)
        assert spark.conf.get(name, None) is None
        size_shuffles(spark, 100 * 256 * 1024 * 1024)
        assert spark.conf.get(name) == "100"
        size_shuffles(spark, 1)
        assert spark.conf.get(name) == "100"
        size_shuffles(spark, 100 * 10**12)
        assert spark.conf.get(name) == str(math.ceil(100 * 10**12 / (256 * 1024 * 1024)))
    finally:
        spark.conf.unset(name)


def test_a_folder_of_parts_has_to_be_complete(spark, tmp_path):
    incoming = tmp_path / "incoming"
    folder = incoming / raw_file_name(2016, 1)
    folder.mkdir(parents=True)
    write_raw(folder / "part-0.csv", ARRIVALS)
    with pytest.raises(landing.SourceIncomplete):
        landing.land(spark, str(incoming), str(tmp_path / "landed"), 2016, 1)
    (folder / "_SUCCESS").touch()
    assert landing.land(spark, str(incoming), str(tmp_path / "landed"), 2016, 1)["rows"] == len(ARRIVALS)


def test_airlines_as_lines_or_as_a_document(spark, tmp_path):
    record = '{"iata": "%s", "name": "n", "country": "c", "active": "Y"}'
    lines = tmp_path / "lines.json"
    lines.write_text("\n".join(record % c for c in ("AA", "BB", "CC")) + "\n")
    document = tmp_path / "document.json"
    document.write_text("[\n" + ",\n".join(record % c for c in ("AA", "BB", "CC")) + "\n]\n")
    for path in (lines, document):
        assert {r.iata for r in read_airlines(spark, str(path)).collect()} == {"AA", "BB", "CC"}
