"""Quality rules against plain Python and on edge cases."""

import textwrap

import pytest
from brute import quality_counts

from starmart.llm import quality
from starmart.llm.queries import op5_quality_rules

CLEAN = "\n".join(" ".join(f"{line}{word}" for word in range(12)) + "." for line in "abcde")
EDGES = [
    None,
    "",
    " \n\t\n",
    "word",
    "a b c a b c a b c",
    "a a a a a",
    "x\nx\nx \n\nx",
    CLEAN,
    CLEAN + "\nHome | News | Sport | About",
    "\n".join(" | ".join(f"w{i}{j}" for j in range(15)) for i in range(6)),
    "\n".join("".join(f"W{i}{j}!! " for j in range(15)) for i in range(6)),
    "é" * 60 + " " + "\x0bü\x0c" * 70,
    "no space" + "x" * 200_000,
    ("long words here " * 20_000),
    "a # b % c & d < e > f | g * h $",
]


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(i, t, "clash") for i, t in enumerate(EDGES)] + [(None, CLEAN, None), (3, "word", "clash")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    return quality.judge(frame).collect()


def test_counts(judged):
    for row in judged:
        expected = quality_counts(row.text)
        assert {k: row[k] for k in expected} == expected


def test_line_rules(judged):
    by_text = {row.text: row for row in judged}
    assert by_text[CLEAN].kept and by_text[CLEAN].cleaned_text == CLEAN
    with_menu = by_text[EDGES[8]]
    assert with_menu.kept and with_menu.cleaned_text == CLEAN
    assert not by_text[EDGES[9]].kept and not by_text[EDGES[9]].base_failed
    assert not by_text[EDGES[10]].kept
    assert not by_text[""].kept and by_text[None].lost == 0


PROSE = [" ".join(f"{p}word{i}" for i in range(40)) + "." for p in "abcdef"]
NOISE = " ".join(["noise"] * 60)
LINES = {
    **{f"wrapped at {n}": ("\n\n".join(textwrap.fill(p, n) for p in PROSE), None) for n in (60, 72, 80)},
    "wrapped without blank lines": ("\n".join(textwrap.fill(p, 72) for p in PROSE), None),
    "headings and a list": (f"Title\n\n{PROSE[0]}\n\nHeading\n{PROSE[1]}\n- one\n- two\n\n{PROSE[2]}", None),
    "danda": ("\n".join(p[:-1] + "।" for p in PROSE), None),
    "arabic question": ("\n".join(p[:-1] + "؟" for p in PROSE), None),
    "armenian, ethiopic": ("\n".join(p[:-1] + "։።"[i % 2] for i, p in enumerate(PROSE)), None),
    "thai": ("\n".join(" ".join(["ภาษาไทย" * 8] * 10) for _ in range(6)), None),
    "long line without a mark": (f"{PROSE[0]}\n{NOISE}\n{PROSE[1]}", f"{PROSE[0]}\n{PROSE[1]}"),
    "wrapped paragraph without a mark": (
        "\n\n".join(textwrap.fill(p, 72) for p in [*PROSE[:2], NOISE, *PROSE[2:]]),
        "\n\n".join([textwrap.fill(p, 72) for p in PROSE[:2]] + [""] + [textwrap.fill(p, 72) for p in PROSE[2:]]).replace("\n\n\n\n", "\n\n\n"),
    ),
    "menu below the text": (f"{PROSE[0]}\nHome\nNews\nImprint", PROSE[0]),
}


def test_paragraphs(spark):
    frame = spark.createDataFrame([(k, t) for k, (t, _) in LINES.items()], "name string, text string")
    cleaned = {r.name: r.cleaned_text for r in quality.judge(frame).collect()}
    assert cleaned == {k: t if left is None else left for k, (t, left) in LINES.items()}


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert quality.judge(empty).collect() == []


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op5_quality_rules(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        expected = quality_counts(texts[row.doc_id])
        assert {k: row[k] for k in expected} == expected
