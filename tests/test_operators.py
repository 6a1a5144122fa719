import pytest
from pyspark.sql import functions as F

from starmart.config import MartConfig
from starmart.operators import dimensions, filters, insert, lookup, profile, summaries
from starmart.operators.dedup import first_per_key
from starmart.schemas import AIRLINE_SOURCE, AIRPORT_SOURCE


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.fixture
def people(spark):
    data = [(1, "a", 3.0), (1, "a", None), (1, None, 9.0), (2, "b", 1.0), (None, "c", 2.0), (None, "c", 1.0)]
    return spark.createDataFrame(data, "id int, name string, v double")


def test_filters(spark, people):
    assert people.filter(filters.all_present(["id", "v"])).count() == 3
    nan = spark.createDataFrame([(float("nan"),), (None,)], "v double")
    assert nan.filter(filters.all_present(["v"])).count() == 1
    assert people.filter(filters.in_values("name", ("a", "c"))).count() == 4
    assert filters.missing(people, "name").count() == 1
    members = spark.createDataFrame([("a",), ("a",), (None,)], "code string")
    assert filters.in_dimension(people, "name", members, "code").count() == 2
    outside = filters.outside_period("id", "v", F.lit(1), F.lit(3))
    inside = filters.in_period("id", "v", F.lit(1), F.lit(3))
    assert people.filter(outside).count() == 4  # a null month with the right year is not counted
    assert people.filter(inside).count() == 1


def test_first_per_key_takes_the_smallest_row(people):
    assert rows(first_per_key(people, ["id"])) == rows(
        people.sparkSession.createDataFrame(
            [(1, None, 9.0), (2, "b", 1.0), (None, "c", 1.0)], people.schema
        )
    )
    by_value = first_per_key(people.filter("id = 1 and v is not null"), ["id"], ["v"])
    assert rows(by_value) == [(1, "a", 3.0)]
    assert first_per_key(people.select("id"), ["id"]).count() == 3


def test_first_per_key_against_brute_force(spark):
    data = [(i % 7, (i * 37) % 11, chr(97 + i % 5)) for i in range(500)] + [(0, 5, "z")] * 300
    frame = spark.createDataFrame(data, "k int, a int, b string").repartition(5)
    best = {}
    for k, a, b in data:
        best[k] = min(best.get(k, (a, b)), (a, b))
    assert rows(first_per_key(frame, ["k"])) == sorted((k, *v) for k, v in best.items())


def test_copies_are_reduced_before_the_shuffle(people):
    plan = first_per_key(people, ["id"])._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    shuffle = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    limits = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line]
    assert any(i > shuffle for i in limits)


def test_insert_if_absent(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 9), ("c", 3), ("c", 4), (None, 5)], "k string, v int")
    assert rows(insert.insert_if_absent(new, old, "k")) == [("a", 1), ("b", 2), ("c", 3)]
    assert rows(insert.keys_met(old, new, "k")) == [("b",)]


def test_history_is_shuffled_when_the_batch_is_large(spark, monkeypatch):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 9), ("c", 3)], "k string, v int")
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 1)
    known = insert.keys_met(old, new, "k")
    assert rows(known) == [("a",), ("b",)]
    assert rows(insert.absent_rows(new, known, "k", unique=True)) == [("c", 3)]


def test_look_up_gives_the_same_rows_beyond_the_broadcast_bound(spark, people, monkeypatch):
    names = spark.createDataFrame([("a", "Ann"), ("b", "Bob")], "code string, full string")
    expected = [(1, "a", "Ann"), (1, "a", "Ann"), (2, "b", "Bob")]

    def joined(how="inner"):
        side = lookup.sized(names)
        found = lookup.look_up(people, "name", side, "code", {"full": "full_name"}, how)
        return found.select("id", "name", "full_name")

    assert rows(joined()) == expected
    assert "BroadcastHashJoin" in joined()._jdf.queryExecution().executedPlan().toString()
    assert joined("left").count() == people.count()
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 1)
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 1)
    assert not lookup.fits_broadcast(names)
    assert rows(joined()) == expected


def test_decode(spark):
    codes = spark.createDataFrame(
        [("port", "CP", "No PORT Code (CP)", "no_code"), ("mode", "XX", "Air", "valid")],
        "domain string, code string, label string, code_class string",
    )
    frame = spark.createDataFrame([("CP ",), ("XX",), (None,)], "c string")
    decoded = lookup.decode(frame, F.col("c"), codes, "port")
    assert rows(decoded) == [
        ("CP ", "No PORT Code (CP)", "no_code"),
        ("XX", "All Other Codes", "other"),
        (None, "All Other Codes", "other"),
    ]


def test_orphan_keys(spark, people):
    names = spark.createDataFrame([("a",), ("b",), ("1",)], "code string")
    numbers = spark.createDataFrame([(2,)], "number int")
    orphans = lookup.orphan_keys(people, {"name": (names, "code"), "id": (numbers, "number")})
    assert rows(orphans) == [("id", "1", 3), ("name", "c", 2)]


def test_clean_airports(spark):
    data = [
        ("Big", "large_airport", "Atlanta", "ATL", "US-GA"),
        ("Copy", "large_airport", "Atlanta", "ATL", "US-GA"),
        ("Tiny", "small_airport", "Macon", "TNY", "US-GA"),
        ("Away", "large_airport", "Miami", "MIA", "US-FL"),
        ("None", "medium_airport", "Augusta", None, "US-GA"),
        ("Sea", "medium_airport", None, "SAV", "US-GA"),
    ]
    airports = dimensions.clean_airports(
        spark.createDataFrame(data, AIRPORT_SOURCE), MartConfig()
    )
    assert rows(airports) == [
        ("ATL", "large_airport", "Big", "Atlanta"),
        ("SAV", "medium_airport", "Sea", None),
    ]
    assert rows(dimensions.municipalities(airports)) == [("Atlanta",)]


def test_clean_airlines(spark):
    data = [
        ("-", "Private flight", "", "Y"),
        ("-", "PRIVATE FLIGHT", "", "Y"),
        ("DL", "Delta", "US", "Y"),
        ("GO", "Gone", "US", "N"),
        (None, "No code", "US", "Y"),
        ("", "Empty", "US", "Y"),
        ("EN", "", "US", "Y"),
        ("NN", None, "US", "Y"),
        ("NA", "Unknown activity", "US", None),
    ]
    frame = spark.createDataFrame(data, AIRLINE_SOURCE)
    assert rows(dimensions.clean_airlines(frame, MartConfig())) == [("DL", "Delta", "US")]


def test_seeds(spark):
    assert dimensions.seed(spark, "visatypes").count() == 3
    assert dimensions.seed(spark, "genders").count() == 4
    assert dimensions.seed(spark, "agegroups").count() == 5


def test_period_rows(spark):
    periods = spark.createDataFrame([(2016, 1), (2016, 1), (2016, 12)], "year int, month_num int")
    made = dimensions.period_rows(periods)
    assert rows(made["years"]) == [(2016,)]
    assert rows(made["months"]) == [(1, "Jan"), (12, "Dec")]
    assert rows(made["monthlytimes"]) == [("12_2016", 2016, 12), ("1_2016", 2016, 1)]


def test_summaries(people):
    assert rows(summaries.row_count(people)) == [(6,)]
    assert [tuple(r) for r in summaries.frequencies(people, "name").collect()] == [
        ("a", 2),
        ("c", 2),
        ("b", 1),
    ]
    assert rows(summaries.distinct_counts(people, ["id", "name"])) == [("id", 3), ("name", 4)]
    assert rows(summaries.distinct_values(people, ["id"])) == [
        ("id", "1"),
        ("id", "2"),
        ("id", None),
    ]
    averaged = summaries.averages(people, "v", {"all": None, "ones": F.col("id") == 1})
    assert rows(averaged) == [(3.2, 6.0)]


def test_latest_period(spark):
    schema = "y double, m double"
    periods = spark.createDataFrame([(2015.0, 12.0), (2016.0, 2.0), (2016.0, 1.0)], schema)
    assert rows(summaries.latest_period(periods, "y", "m")) == [(2016, 2)]
    empty = spark.createDataFrame([], schema)
    assert rows(summaries.latest_period(empty, "y", "m")) == [(None, None)]


def test_rollup_counts(spark):
    data = [(2016, 1)] * 3 + [(2016, 2)] + [(2017, 1)]
    frame = spark.createDataFrame(data, "y int, m int")
    assert rows(summaries.rollup_counts(frame, "y", "m")) == [
        (2016, 1, 3, 2),
        (2016, 2, 1, 2),
        (2016, None, 4, 1),
        (2017, 1, 1, 2),
        (2017, None, 1, 1),
        (None, None, 5, 0),
    ]


def test_step_counts(people):
    steps = {"id": F.col("id").isNotNull(), "v": F.col("v") > 1}
    counted = summaries.step_counts(people, steps).orderBy("step_no").collect()
    assert [(r.step, r.rows) for r in counted] == [("read", 6), ("id", 4), ("v", 2)]


def test_step_counts_with_a_key(spark):
    frame = spark.createDataFrame([(1, 2), (1, 3), (2, 0), (None, 4)], "k int, v int")
    counted = summaries.step_counts(frame, {"v": F.col("v") > 0}, "k").orderBy("step_no")
    assert [r.rows for r in counted.collect()] == [4, 3, 1]


def test_monthly_and_yearly(spark):
    frame = spark.createDataFrame([(2016, 1, "a"), (2016, 2, "a"), (2016, 2, None)], "Year int, Month int, c string")
    assert rows(summaries.monthly_and_yearly(frame, ["c"])) == rows(
        spark.createDataFrame(
            [
                ("c", "a", 2016, 1, 1),
                ("c", "a", 2016, 2, 1),
                ("c", "a", 2016, None, 2),
                ("c", None, 2016, 2, 1),
                ("c", None, 2016, None, 1),
            ],
            "attribute string, value string, Year int, Month int, n int",
        )
    )


def test_profiles(spark, people):
    wide = people.withColumn("none", F.lit(None).cast("string"))
    assert rows(profile.null_profile(wide)) == [
        ("id", 6, 2, False),
        ("name", 6, 1, False),
        ("none", 6, 6, True),
        ("v", 6, 1, False),
    ]
    empty = profile.null_profile(people.limit(0))
    assert all(r.all_null for r in empty.collect())
    assert rows(profile.shape(people)) == [(6, 3)]
