"""Near duplicates against brute force, with hot groups, any order of hubs, and edge cases."""

import random

import numpy as np
import pytest
from brute import near_components

from starmart.llm import near, rtree, shingles
from starmart.llm.queries import op2_ngram_join


def found(frame):
    rows = near.near_duplicates(frame).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str)


def copies(noise, words, k):
    """A text with k words changed, which changes up to five shingles each."""
    out = list(words)
    for _ in range(k):
        out[noise.randrange(len(out))] = f"new{noise.randrange(10**9)}"
    return " ".join(out)


@pytest.fixture(scope="module")
def corpus():
    noise = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    docs = []
    for _ in range(12):
        base = noise.choices(vocabulary, k=noise.choice([3, 8, 30, 120, 300]))
        docs += [copies(noise, base, noise.choice([0, 0, 1, 2, 4, 9])) for _ in range(noise.choice([1, 2, 5, 40]))]
    passage = noise.choices(vocabulary, k=60)
    docs += [" ".join(noise.choices(vocabulary, k=80) + passage + noise.choices(vocabulary, k=80)) for _ in range(60)]
    hot = noise.choices(vocabulary, k=100)
    docs += [copies(noise, hot, noise.randrange(6)) for _ in range(150)]
    docs += ["A b C d e f", "a B c D e F", "a b c d", "A B C D", "a b c", "", None, " ", "x" * 30_000]
    noise.shuffle(docs)
    rows = [(i * 3 % 1009, t) for i, t in enumerate(docs)]
    return rows + [(5, "repeated row here today for you"), (5, "repeated row here today for you"), (None, "a b c d")]


@pytest.mark.parametrize("large", [near.LARGE, 3])
def test_brute_force(spark, corpus, monkeypatch, large):
    monkeypatch.setattr(near, "LARGE", large)
    monkeypatch.setattr(near, "CHUNK", 40)
    monkeypatch.setattr(near, "CHUNK_SHINGLES", 3000)
    frame = spark.createDataFrame([(*r, "c") for r in corpus], "doc_id long, text string, node string")
    assert found(frame) == near_components(corpus)


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near.near_duplicates(empty).collect() == []
    assert near.one_of_each(empty).collect() == []


def test_one_of_each(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(4, text, "a"), (2, text.upper(), "b"), (9, None, "c"), (8, "", "d"), (7, "other words", "e"), (7, "other words", "e")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = near.one_of_each(frame)
    assert out.columns == frame.columns
    assert sorted(r.doc_id for r in out.collect()) == [2, 7, 8, 9]


def test_rtree_finds_every_pair_that_can_link():
    noise = np.random.default_rng(2)
    sets = [np.unique(noise.integers(0, 1 << 62, n).astype(np.uint64)) for n in noise.integers(1, 300, 80)]
    sets += [np.unique(np.append(s[: len(s) * 9 // 10], noise.integers(0, 1 << 62, 3).astype(np.uint64))) for s in sets]
    points = np.array([rtree.count_vector(s) for s in sets])
    tree = rtree.RTree(points)
    for i, s in enumerate(sets):
        hits = set(tree.search(points[i]).tolist())
        for j, t in enumerate(sets):
            common = len(np.intersect1d(s, t))
            if 100 * common >= 75 * (len(s) + len(t) - common):
                assert j in hits


def test_finer_vectors_bound_the_overlap():
    """For sets of any sizes: packed, folded to common groups, never below what they share."""
    noise = np.random.default_rng(3)
    for n in (1, 5, 1024, 1025, 9000):
        s = np.unique(noise.integers(0, 1 << 62, n).astype(np.uint64))
        t = np.append(s[: n // 2], noise.integers(0, 1 << 62, 3 * n).astype(np.uint64))
        a, b = (rtree.unpacked(rtree.packed(rtree.count_vector(x, rtree.groups_for(len(x))))) for x in (s, t))
        assert (a.sum(), b.sum()) == (len(s), len(t))
        assert len(np.intersect1d(s, t)) <= rtree.overlap_bound(a, b) <= len(s)
    crowded = np.arange(0, 1 << 20, 256, dtype=np.uint64)
    assert rtree.unpacked(rtree.packed(rtree.count_vector(crowded))).tolist() == [4096] + [0] * 255


def test_a_cluster_returns_a_forest_of_its_links():
    """Fewer rows than nodes, whatever the number of links; known components are not linked again."""
    base = np.arange(1000, 1400, dtype=np.uint64)
    sets = [np.sort(np.append(base[k:], np.arange(k, dtype=np.uint64) + np.uint64(5000 + 100 * k))) for k in range(30)]
    rows = [(1, 0, 0, bytes([k]), bytes([0 if k < 10 else k]), 0, s.tobytes()) for k, s in enumerate(sets)]
    links = list(near._links_of(rows))
    assert len(links) == 20
    for u, v in links:
        a, b = sets[u[0]], sets[v[0]]
        common = len(np.intersect1d(a, b))
        assert 100 * common >= 75 * (len(a) + len(b) - common)


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = op2_ngram_join(spark, sf_dir).collect()
    assert sorted((tuple(r) for r in rows), key=str) == near_components(docs)


def test_shingles():
    sizes = [len(s) for s in shingles.shingle_sets([None, "", "a", "A b", "a b c d e", "a b c d e f", " \x0b\x0c "])]
    assert sizes == [0, 0, 1, 1, 1, 2, 0]
    one, two, three = shingles.shingle_sets(["A\tB  c d E f", "a b C d e F", "a b c d e é"])
    assert np.array_equal(one, two) and len(np.intersect1d(one, three)) == 1
