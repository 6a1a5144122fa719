"""Language by cross-parsing against a plain parse, on edge cases and on held-out documents."""

import random
import zlib

import numpy as np

from starmart.llm import langid
from starmart.llm.queries import op9_language

SAMPLES = {"aa": "banana bandana cabana", "bb": "the quick brown fox", "cc": "äöü ñandú façade"}


def phrases(text, known):
    """Longest stretches that the known text contains, per stretch of the operator's length."""
    count = 0
    for at in range(0, len(text), langid.STRETCH):
        piece, start = text[at : at + langid.STRETCH], 0
        for end in range(1, len(piece) + 1):
            if piece[start:end] not in known:
                count += 1
                start = end - 1 if piece[end - 1] in known else end
        count += 1
    return count


def test_phrases_equal_a_plain_parse(monkeypatch):
    noise = random.Random(9)
    texts = ["".join(noise.choices("abndqfxo zäñ", k=n)) for n in (1, 2, 3, 50, 511, 512, 513, 1500)]
    for dense in (256, 1):
        monkeypatch.setattr(langid, "DENSE_LETTERS", dense)
        parser = langid.Parser(langid.learn(SAMPLES))
        counts = parser.phrases(texts)
        expected = [[phrases(t, SAMPLES[name]) for name in parser.languages] for t in texts]
        assert np.array_equal(counts, expected)


def test_edges(spark):
    automata = langid.learn(SAMPLES)
    rows = [(1, None), (2, ""), (3, "12 !?"), (4, "Banana BANDANA"), (4, "brown fox"), (None, "façade " * 9000)]
    frame = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, score string")
    out = langid.identify(frame, automata).collect()
    assert [r.lang_pred for r in out] == ["und", "und", "und", "aa", "bb", "cc"]
    assert all(0 <= r.score <= 1 for r in out)
    nothing = langid.identify(frame, langid.learn({})).collect()
    assert {r.lang_pred for r in nothing} == {"und"}
    assert langid.identify(frame.limit(0), automata).collect() == []


def test_sample_takes_no_held_out_row(spark):
    rows = [(i, f"word{chr(97 + i % 26)} text", "en" if i % 2 else None) for i in range(300)] + [(None, "null id", "xx")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = langid.sample(frame)
    assert set(learned) == {"en"} and len(learned["en"]) <= langid.SAMPLE_CHARS
    assert learned == langid.sample(frame.repartition(7))


def test_query(spark, sf_dir):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op9_language(spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    tested = [r for r in rows if r.held_out and docs[r.doc_id].text]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in tested) >= 0.97 * len(tested)
