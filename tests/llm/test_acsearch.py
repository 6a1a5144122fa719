"""Ranked lexical search against a plain version; its SQL is run with the others'."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import acsearch

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain(docs, items, k):
    counted = [(doc_id, Counter(terms_of(text))) for doc_id, text in docs]
    counted = [(doc_id, tf, sum(tf.values())) for doc_id, tf in counted if tf]
    number, length = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, tf, _ in counted for t in tf)
    wanted = {}
    for item_id, text in items:
        wanted.setdefault(item_id, set()).update(terms_of(text))
    out = []
    for item_id, terms in wanted.items():
        scored = []
        for doc_id, tf, n in counted:
            m = 10 + 90 * n * number // length
            score = sum(
                math.floor(1000 * math.log((2 * number + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m))
                for t in terms
                if t in tf
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, i + 1, doc_id, -s) for i, (s, _, _, doc_id) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def found(spark, docs, items, k=10):
    left = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({"n": F.lit("x"), "terms": F.lit(1), "item_id": F.lit(2)})
    right = spark.createDataFrame(items, "item_id bigint, text string").withColumns({"term": F.lit(0), "doc_id": F.lit(9)})
    return sorted(map(tuple, acsearch.search(left, right, k).collect()), key=str)


HAND = [
    (1, "Alpha beta, gamma's ÄPFEL-mus 42"),
    (2, "ALPHA alpha alphabet é日本 beta"),
    (3, None),
    (4, ""),
    (5, "...!?"),
    (None, "beta gamma gamma"),
    (6, "beta gamma gamma"),
    (6, "beta gamma gamma"),
    (7, "über beta_gamma \x00 42"),
]
ITEMS = [(10, "alpha GAMMA 日本"), (11, None), (12, "?"), (13, "not there"), (None, "beta"), (10, "gamma 42"), (14, "Äpfel äpfel"), (14, "Äpfel äpfel")]


def test_by_hand(spark):
    for k in (1, 3, 10):
        assert found(spark, HAND, ITEMS, k) == plain(HAND, ITEMS, k)


def test_empty_tables(spark):
    assert found(spark, [], ITEMS) == found(spark, HAND, []) == found(spark, [(1, None)], ITEMS) == []


@pytest.fixture
def noise():
    pick = random.Random(11)
    letters = ["a", "B", "b", "ß", "é", "7", "ab", "日"]
    word = lambda: "".join(pick.choices(letters, k=pick.randrange(1, 3)))
    text = lambda n: pick.choice([" ", "-", "\n "]).join(word() for _ in range(pick.randrange(n)))
    docs = [(i // 2 if i % 9 else None, text(60)) for i in range(300)] + [(900, "b " * 200_000 + "a")]
    return docs, [(i % 20, text(9)) for i in range(25)]


def test_noise_and_blocks(spark, noise, monkeypatch):
    """Many equal scores; small blocks, chunks and deals give what one block gives."""
    expected = plain(*noise, 4)
    assert found(spark, *noise, 4) == expected
    monkeypatch.setattr(acsearch, "BLOCK_ITEMS", 6)
    monkeypatch.setattr(acsearch, "CELLS", 50)
    assert acsearch._blocks(acsearch.term_pairs(spark.createDataFrame(noise[1], "item_id bigint, text string"))) > 1
    assert found(spark, *noise, 4) == expected


def test_lengths_beyond_64_bits():
    n = np.array([1, 10**6, 10**9], np.int64)
    assert acsearch.length_parts(n, 10**11, 10**13).tolist() == [10 + 90 * x * 10**11 // 10**13 for x in n.tolist()]
