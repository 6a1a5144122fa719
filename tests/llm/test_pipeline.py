"""The pipeline, stage by stage, against plain Python on a small table."""

import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken
from brute import WORD, base_spans, near_components, quality_counts

import corpus_pipeline
from starmart.llm import bpe, quality

DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def line_fails(line):
    symbols = sum(c in quality.SYMBOLS for c in line)
    blanks, bars = line.count(" "), sum(c in quality.SEPARATORS for c in line)
    shouts = len(line) - len(line.replace("!!", "!"))
    return bool(
        (symbols >= 3 and symbols * 10 > len(line))
        or (shouts >= 3 and shouts * 4 > blanks)
        or not re.search(quality.SENTENCE_MARK, line)
        or (bars >= 3 and blanks < 6 * bars)
        or re.search(quality.BOILERPLATE, line)
    )


def cleaned(text):
    return "\n".join(x for x in (text or "").split("\n") if not WORD.search(x) or not line_fails(x))


def size(text):
    return sum(map(len, WORD.findall(text or "")))


@pytest.fixture(scope="module")
def tables(spark, sf_dir, tmp_path_factory):
    """Documents and what every stage makes of them."""
    root = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(str(root / name))
        docs = spark.read.parquet(str(root / name))
        out.append(docs.collect())
        if name != "token_ids":
            assert docs.columns == DOCUMENT
            assert all(r.n_chars == len(r.text) for r in out[-1])
    return out


def texts(rows):
    return sorted((r.doc_id, r.text) for r in rows)


def test_quality(tables):
    expected = []
    for r in tables[0]:
        rest = cleaned(r.text)
        if not quality_counts(r.text)["base_failed"] and 2 * size(rest) >= size(r.text):
            expected.append((r.doc_id, rest))
    assert texts(tables[1]) == sorted(expected) and len(expected) > len(tables[0]) // 2


def test_near_duplicates(tables):
    rows = near_components([(r.doc_id, r.text) for r in tables[1]])
    stay = {doc_id for doc_id, _, component in rows if doc_id == component}
    assert texts(tables[2]) == [x for x in texts(tables[1]) if x[0] in stay]


def test_personal_data(tables):
    before = dict(texts(tables[2]))
    for doc_id, text in texts(tables[3]):
        spans = base_spans(before[doc_id])
        assert (text == before[doc_id]) == (not spans)
        assert not base_spans(text)
        assert sum(text.count(f"[{k.upper()}]") for k in ("email", "ip", "card", "phone")) <= len(spans)
    assert len(tables[3]) == len(tables[2])


def test_mix(tables):
    before, after = {r.doc_id: r for r in tables[3]}, tables[4]
    words, total = defaultdict(int), 0
    for r in after:
        own = Counter(WORD.findall(r.text))
        assert not own - Counter(WORD.findall(before[r.doc_id].text))
        assert (r.lang, r.source) == (before[r.doc_id].lang, before[r.doc_id].source)
        words[r.doc_id] += own.total()
        total += own.total()
    sizes = {i: len(WORD.findall(r.text)) for i, r in before.items()}
    assert all(words[i] <= 2 * n for i, n in sizes.items())
    assert abs(total - 1.5 * sum(sizes.values())) < 0.03 * sum(sizes.values())


def test_token_ids(tables):
    ranks = bpe.read_ranks(public_tokenizers.path(corpus_pipeline.RANKS))
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    expected = sorted((r.doc_id, library.encode_ordinary(r.text)) for r in tables[4])
    assert sorted((r.doc_id, list(r.token_ids)) for r in tables[5]) == expected
    assert all(r.n_tokens == len(r.token_ids) for r in tables[5])


def test_run(spark, sf_dir, tables):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((r.doc_id, list(r.token_ids)) for r in rows) == sorted(
        (r.doc_id, list(r.token_ids)) for r in tables[5]
    )


def test_no_rows_and_odd_rows(spark, sf_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string"
    for rows in ([], [(None, None, None, None, None, "c"), (1, "", "en", "a", 0, "c"), (1, "", "en", "a", 0, "c")]):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, spark.createDataFrame(rows, schema), sf_dir).count() <= len(rows)


def test_columns_named_as_an_operators(spark, sf_dir):
    """They stay what they are, through the stages that keep columns."""
    text = " ".join(f"First{i} second{i}, third{i} fourth{i} a{i}@b.cd sixth{i}." for i in range(20))
    names = ["kept", "lost", "n_words", "cleaned_text", "email_spans", "_row", "_text", "mark", "component"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names)
    docs = spark.createDataFrame([(1, text, "en", "a", len(text), *names)], schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        rows = out.collect()
        assert out.columns == docs.columns and rows, name
        assert all([r[n] for n in names] == names for r in rows), name
