"""Personal data against plain Python and on edge cases."""

import random

import pytest
from pyspark.sql import functions as F
from brute import base_spans, sha

from starmart.llm import pii
from starmart.llm.queries import op10_pii

IBAN = "GB82 WEST 1234 5698 7654 32"
EDGES = [
    None,
    "",
    "nothing here",
    "a@b.co_x@y.com z@q.w.e",
    "1.2.3.4.5.6.7.8 and 256.1.1.1 and 001.002.003.004 or 1.2.3",
    "4111 1111 1111 1111 then 4111-1111-1111-1112 then 4 1 1",
    "+1 (555) 123-4567 and +12 and +1 555 and ++49.30.123456 x",
    "ééé é.a@b.ü.com 😀 a@b.cd 😀 10.0.0.1",
    f"pay to {IBAN} or GB82 WEST 1234 5698 7654 33",
    "my SSN is 123-45-6789; part 123-45-6789",
    "a" * 100_000,
    "a." * 50_000 + "@x.y",
    "1 " * 50_000,
    "x@" + "y." * 50_000 + "z",
    "+1" + " " * 50_000 + "2",
    "mail a@b.cd " * 500,
]
KIND_NAMES = list(pii.BASE_KINDS)


def base_of(row):
    return [(k, s.start, s.end) for k in KIND_NAMES for s in row[f"{k}_spans"]]


@pytest.fixture(scope="module")
def found(spark):
    noise = random.Random(5)
    alphabet = "0123456789" * 3 + ".-+@ ()ab_é\n"
    texts = EDGES + ["".join(noise.choices(alphabet, k=80)) for _ in range(400)]
    frame = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, email_spans string")
    return pii.find(frame).collect()


def test_base_spans(found):
    for row in found:
        assert base_of(row) == base_spans(row.text), row.text[:200]


def test_added_kinds(found):
    by_text = {row.text: row for row in found}
    iban = by_text[EDGES[8]]
    assert [(s.start, s.end) for s in iban.iban_spans] == [(7, 7 + len(IBAN))]
    assert [s.start for s in by_text[EDGES[9]].ssn_spans] == [10]


def test_context_raises_the_score(spark):
    frame = spark.createDataFrame([("write to a@b.cd",), ("xx a@b.cd",)], "text string")
    near, far = pii.find(frame).select("email_spans").collect()
    assert near[0][0].score > far[0][0].score


SSNS = {
    "SSN: 123-45-6789, 987-65-4321": 2,
    "SSN\n" + "\n".join(f"{i}-45-6789" for i in range(100, 160)): 60,
    "123-45-6789 (SSN)": 1,
    "987-65-4321, 123-45-6789 (SSN)": 2,
    "SSNs 123-45-6789 and 987-65-4321": 2,
    "name, SSN\nAnn, 123-45-6789\nBea, 987-65-4321": 2,
    "part 123-45-6789, part 987-65-4321": 0,
    "SSN 123-45-6789 " + "x" * 60 + " 987-65-4321": 1,
}


def test_context_around_and_neighbours(spark):
    frame = spark.createDataFrame([(t,) for t in SSNS], "text string")
    for row in pii.find(frame).collect():
        assert len(row.ssn_spans) == SSNS[row.text], row.text
        assert all(row.text[s.start : s.end].count("-") == 2 for s in row.ssn_spans)


def test_masked(spark):
    texts = ["x a@b.cd, 10.0.0.1.", "clean", None, "+1 (555) 123-4567"]
    frame = pii.find(spark.createDataFrame([(t,) for t in texts], "text string"))
    out = [r[0] for r in frame.select(pii.masked(pii.whole_text("text"))).collect()]
    assert out == ["x [EMAIL], [IP].", "clean", "", "[PHONE]"]


def test_no_rows(spark):
    assert pii.find(spark.createDataFrame([], "text string")).collect() == []


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op10_pii(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        expected = [f"{k}:{s}:{e}" for k, s, e in base_spans(texts[row.doc_id])]
        assert row.base_sha256 == sha(",".join(expected))
        assert row.spans.split(",")[: len(expected)] == (expected or [""])[: len(expected)]
        assert row.n_email == sum(x.startswith("email") for x in expected)


def test_very_many_matches_in_one_text(spark):
    """Found and masked run by run: as many as a long server log has."""
    text = " ".join(f"10.{i % 250}.{i // 250 % 250}.7" + " a@b.cd" * (i % 700 == 0) for i in range(20_000))
    row = pii.find(spark.createDataFrame([(text,)], "text string")).withColumn("masked", pii.masked(F.col("text"))).first()
    assert base_of(row) == base_spans(text)
    assert row.masked == " ".join("[IP]" + " [EMAIL]" * (i % 700 == 0) for i in range(20_000))


@pytest.mark.parametrize("n", [1, 2, 255, 256, 257, 513])
def test_masking_at_the_ends_of_runs(spark, n):
    text = "é" + "😀 1.2.3.4" * n
    row = pii.find(spark.createDataFrame([(text,)], "text string")).withColumn("masked", pii.masked(F.col("text"))).first()
    assert row.masked == "é" + "😀 [IP]" * n
