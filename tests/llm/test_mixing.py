"""Mixing against a plain plan and on edge cases."""

import re
from collections import defaultdict

import numpy as np
import pytest

from starmart.llm import mixing
from starmart.llm.queries import op3_mixing


def plain_targets(sizes):
    """By source; weights 3, 1, 2 in order of code points, null last."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    out, rest, left = {}, 1.5 * sum(sizes.values()), set(order)
    while left:
        unit = rest / sum(weight[s] for s in left)
        full = [s for s in left if weight[s] * unit > 2 * sizes[s]]
        if not full:
            return out | {s: weight[s] * unit for s in left}
        for s in full:
            out[s] = 2.0 * sizes[s]
            rest -= out[s]
            left.remove(s)
    return out


def check(rows, docs, near=0.05):
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, text, source in docs:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = plain_targets(sizes)
    source_of = {i: s for i, _, s in docs}
    assert len(rows) == len(docs)
    for r in rows:
        source = source_of[r.doc_id]
        assert r.source_size == sizes[source] and r.target == pytest.approx(want[source])
        assert 0 <= r.taken <= 2 * r.size
        taken[source] += r.taken
    for source, words in taken.items():
        assert abs(words - want[source]) <= max(mixing.BLOCK, near * want[source])


def test_permutation():
    for size in (1, 2, 3, 7, 64, 65, 1000):
        for key in (1, 2):
            out = mixing.permuted(np.arange(size), size, key)
            assert sorted(out.tolist()) == list(range(size))
    assert mixing.permuted(np.arange(1000), 1000, 1).tolist() != mixing.permuted(np.arange(1000), 1000, 2).tolist()


@pytest.mark.parametrize(
    "docs",
    [
        [(1, None, "a"), (2, "", None)],
        [(1, "one two", "a"), (2, "w " * 5000, "b"), (3, "x " * 9000, None), (4, None, "c"), (5, "y " * 20_000, "d")],
        [(i, "word " * (i % 90), ["hot", "a", "z", None][(i % 5) // 2 if i % 7 else 3]) for i in range(3000)],
    ],
)
def test_edges(spark, docs):
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, source string, size int")
    rows = mixing.mix(frame).collect()
    check(rows, docs)
    again = mixing.mix(frame.repartition(5)).collect()
    assert sorted((r.doc_id, r.taken) for r in rows) == sorted((r.doc_id, r.taken) for r in again)


def test_no_rows_and_repeated_rows(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.mix(spark.createDataFrame([], schema)).collect() == []
    frame = spark.createDataFrame([(None, "a b c " * 100, None)] * 3, schema)
    rows = mixing.mix(frame).collect()
    assert len(rows) == 3 and all(r.taken <= 2 * r.size for r in rows)


def test_documents_of_the_mix(spark):
    docs = [(i, " ".join(f"w{i}x{j}" for j in range(300)) + " ", "ab"[i % 2], 7) for i in range(20)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string, n_chars long")
    taken = {r.doc_id: r.taken for r in mixing.mix(frame).collect()}
    out = mixing.mixed_documents(frame)
    assert out.columns == frame.columns
    words = defaultdict(int)
    for r in out.collect():
        assert r.n_chars == len(r.text)
        words[r.doc_id] += len(r.text.split())
        assert set(r.text.split()) <= set(docs[r.doc_id][1].split())
    assert dict(words) == {i: n for i, n in taken.items() if n}


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(op3_mixing(spark, sf_dir).collect(), docs)
