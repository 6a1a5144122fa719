"""Lempel-Ziv fingerprints against a plain parse and on edge cases."""

import random

import numpy as np
import pytest
from brute import sha

from starmart.llm import lz
from starmart.llm.queries import op1_lz_fingerprint


def phrases(text):
    found, start = set(), 0
    for end in range(1, len(text) + 1):
        if text[start:end] not in found:
            found.add(text[start:end])
            start = end
    return found


def expected(rows):
    """By doc_id downwards, null last, then text."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] or "").encode()))
    out = []
    for i, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        k = len(text) // 3
        out.append((doc_id, text, text[: len(text) - k] + following[:k], following))
    return out


def check(frame, rows):
    got = sorted(frame.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_chars, r.edited_sha256))
    want = sorted(expected(rows), key=lambda r: (r[0] is None, r[0] or 0, len(r[1]), sha(r[2])))
    assert len(got) == len(want)
    for g, (doc_id, text, changed, following) in zip(got, want, strict=True):
        assert (g.doc_id, g.n_chars, g.edited_sha256) == (doc_id, len(text), sha(changed))
        own, other, after = map(lz.text_hashes, (text, changed, following))
        assert g.fingerprint == lz.fingerprint(own)
        assert g.edited_fingerprint == lz.fingerprint(other)
        assert g.near_edited == lz.likeness(own, other) and 0 <= g.near_edited <= 1
        assert g.near_next == lz.likeness(own, after)


EDGES = [
    [],
    [(1, "only one row, followed by itself")],
    [(None, None), (None, "a"), (None, "b")],
    [(5, "abc"), (5, "abc"), (5, "abd"), (4, None), (3, ""), (None, "x" * 50), (9, "zz")],
    [(i, "é😀" * i + "tail" * (i % 7)) for i in range(60)] + [(7, "again"), (7, "again")],
    [(1, "a" * 200_000), (2, "ab" * 100_000), (3, "short")],
]


@pytest.mark.parametrize("rows", EDGES)
@pytest.mark.parametrize("ranges", [1, 4, 50])
def test_edges(spark, rows, ranges):
    frame = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, fingerprint int")
    check(lz.compared(frame, ranges=ranges), rows)


def test_hashes_follow_the_phrases():
    noise = random.Random(3)
    for n in (0, 1, 5, 400, 3000):
        text = "".join(noise.choices("abcd é", k=n))
        ends = lz.Parse().read(lz.codes_of(text).tolist()).ends
        stops = [0, *ends]
        assert {text[a:b] for a, b in zip(stops, stops[1:], strict=False)} == phrases(text)
        every = lz.smallest_hashes(lz.codes_of(text), ends, 10**6)
        assert len(every) == len(phrases(text))
        assert np.array_equal(every[: lz.SIZE], lz.text_hashes(text))
        assert np.array_equal(lz.hashes_of(lz.fingerprint(every)), every)


def test_equal_phrases_have_equal_hashes_anywhere():
    a, b = "xyz" + "q", "q" + "xyz"
    one = lz.smallest_hashes(lz.codes_of(a), [3, 4], 9)
    two = lz.smallest_hashes(lz.codes_of(b), [1, 4], 9)
    assert np.array_equal(one, two)


def test_likeness_follows_the_phrase_sets():
    noise = random.Random(4)
    words = ["".join(noise.choices("abcdefgh", k=6)) for _ in range(400)]
    text = " ".join(noise.choices(words, k=4000))
    near = text[:-4000] + " ".join(noise.choices(words, k=600))
    a, b = phrases(text), phrases(near)
    exact = len(a & b) / len(a | b)
    assert abs(lz.likeness(lz.text_hashes(text), lz.text_hashes(near)) - exact) < 0.15
    other = "".join(noise.choices("rstuvw", k=20_000))
    assert lz.likeness(lz.text_hashes(text), lz.text_hashes(other)) < 0.1


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(op1_lz_fingerprint(spark, sf_dir), rows)


def test_plain_fingerprints(spark):
    frame = spark.createDataFrame([(1, None, "x"), (2, "abab", "y")], "doc_id long, text string, fingerprint string")
    rows = lz.fingerprints(frame).collect()
    assert [r.fingerprint for r in rows] == ["", lz.fingerprint(lz.text_hashes("abab"))]
