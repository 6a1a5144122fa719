"""Byte-level BPE against the tiktoken library and by exact round trips."""

import random

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from brute import sha

from starmart.llm import bpe
from starmart.llm.queries import op6_byte_bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.Vocabulary(bpe.read_ranks(PATH)), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={}
    )


EDGES = ["", " ", "a", "a" * 30_000, " " * 5_000 + "x", "ab" * 3_000, "é😀\u0301\n\n\t x", "<|endoftext|>", "\x00\x1c\x85\xa0"]


@pytest.mark.parametrize("text", EDGES)
def test_edges(codec, library, text):
    assert codec.encode(text) == library.encode_ordinary(text)
    assert codec.decode(codec.encode(text)) == text.encode()


def test_noise(codec, library):
    noise = random.Random(6)
    for _ in range(1500):
        text = "".join(
            chr(noise.choice([noise.randrange(32, 127), noise.randrange(0x3000), noise.randrange(0xE000, 0x1FFFF), 32]))
            for _ in range(noise.randrange(1, 40))
        )
        assert codec.encode(text) == library.encode_ordinary(text)


def test_appending_and_editing(codec):
    noise = random.Random(7)
    for _ in range(200):
        piece = bytes(noise.choices(b"thering to be", k=30))
        table = bpe.Prefixes(codec.vocabulary, piece[:12]).append(piece[12:20]).append(piece[20:])
        assert table.tokens() == bpe.Prefixes(codec.vocabulary, piece).tokens()
        changed = piece[:17] + b"xyz"
        assert table.cut(17).append(b"xyz").tokens() == bpe.Prefixes(codec.vocabulary, changed).tokens()


def test_missing_byte():
    with pytest.raises(ValueError):
        bpe.Prefixes(bpe.Vocabulary({b"a": 0}), b"ab")


def test_texts(spark, library):
    rows = [(1, None, "c"), (2, "", "c"), (2, "hello there", None), (None, "hello there", "c")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, token_ids string")
    out = bpe.encode_texts(frame, PATH, public_tokenizers.PATTERN).collect()
    assert [list(r.token_ids) for r in out] == [library.encode_ordinary(t or "") for _, t, _ in rows]
    assert bpe.round_trips(frame.limit(0), PATH, public_tokenizers.PATTERN).collect() == []


def test_ids_of_a_large_batch_are_not_held_at_once(spark, codec, library, monkeypatch):
    """However many rows a batch has, the ids of so many bytes of text only come at once; no text is split."""
    frame = spark.createDataFrame([], "doc_id long, text string")
    monkeypatch.setattr(type(frame), "mapInArrow", lambda self, run, schema: run)
    monkeypatch.setattr(bpe, "_codec", lambda *_: codec)
    run = bpe.encode_texts(frame, PATH, public_tokenizers.PATTERN)
    most = 1 << 22
    longer = "The é 12\n" * (most // 8)
    texts = ["of the " * 30_000] * 60 + [None, longer, ""] + ["a b"] * 1000 + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    out = list(run(iter([batch.slice(3), batch.slice(0, 0)])))
    assert [t for b in out for t in b.column(1).to_pylist()] == texts[3:]
    sizes = [[len((t or "").encode()) for t in b.column(1).to_pylist()] for b in out]
    assert len(out) > 3 and all(sum(own) - max(own, default=0) <= most for own in sizes)
    wanted = {t: library.encode_ordinary(t or "") for t in set(texts)}
    assert all(ids == wanted[t] for b in out for t, ids in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True))
    assert {b.schema.field("token_ids").type for b in out} == {pa.list_(pa.int32())}


def test_query(spark, sf_dir, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op6_byte_bpe(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(",".join(map(str, ids))))
        assert r.decoded_sha256 == sha(texts[r.doc_id])
