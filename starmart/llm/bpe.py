"""Byte-level BPE by dynamic programming over prefixes.

For every byte prefix of a piece, exactly one token can come last in the prefix's encoding: a token that
ends there, encodes to itself, and may follow the last token of the prefix it leaves. Two tokens may
follow each other when the merges on their joined bytes give back just these two. The table of last
tokens is filled once from left to right; the encoding is read backwards from its end.

The table of a prefix does not depend on what follows, so appending bytes extends it and an edit only
refills it from the edit on (``Prefixes``). Pieces are the matches of a pattern, encoded separately; a
piece that is a token itself is that token.

Defined results: a null or empty text has no tokens and decodes to no bytes; rows are independent, so
repeated rows and ids give repeated results. Texts of any length are encoded whole. Of the input columns
all stay where ``token_ids`` is added, which replaces one of that name.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame

KEPT_PIECES = 150_000  # encodings of pieces remembered per worker, and as many older ones
KEPT_PAIRS = 1_000_000  # pairs of tokens remembered per worker
RUN_BYTES = 1 << 22  # of texts whose ids are held at once; one text is never split
ENCODED = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Vocabulary:
    """Ranks of byte strings, and which tokens may stand side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        #: Finds the tokens ending at each byte, the longest first. Bytes are written as Latin-1.
        self.endings = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.endings.add_word(token.decode("latin-1"), (rank, len(token)))
        self.endings.make_automaton()
        self.longest = max(map(len, ranks), default=0)
        self.alone: dict[int, bool] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    def merged(self, piece: bytes) -> list[bytes]:
        """The piece after merging the lowest rank first, leftmost among equals; for short pieces."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            ranked = [
                (self.ranks[parts[i] + parts[i + 1]], i)
                for i in range(len(parts) - 1)
                if parts[i] + parts[i + 1] in self.ranks
            ]
            if not ranked:
                break
            at = min(ranked)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stands_alone(self, token: int) -> bool:
        known = self.alone.get(token)
        if known is None:
            known = self.alone[token] = len(self.merged(self.bytes_of[token])) == 1
        return known

    def may_follow(self, before: int, token: int) -> bool:
        known = self.pairs.get((before, token))
        if known is None:
            left, right = self.bytes_of[before], self.bytes_of[token]
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            known = self.pairs[(before, token)] = self.merged(left + right) == [left, right]
        return known


class Prefixes:
    """The last token of each byte prefix of a piece; grows by appending, shrinks by cutting."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self.vocabulary = vocabulary
        self.piece = b""
        self.last: list[int] = []
        self.append(piece)

    def append(self, more: bytes) -> Prefixes:
        v, last = self.vocabulary, self.last
        done = len(last)
        self.piece += more
        seen = max(0, done - v.longest)  # a token over the joint starts here at the earliest
        alone, pairs = v.alone.get, v.pairs.get
        for at, (token, length) in v.endings.iter(self.piece[seen:].decode("latin-1")):
            at += seen
            if at < done or not (alone(token) or v.stands_alone(token)):
                continue
            if at >= length:
                before = last[at - length]
                follows = pairs((before, token))
                if not (v.may_follow(before, token) if follows is None else follows):
                    continue
            last.append(token)
            done += 1
        if len(last) < len(self.piece):
            raise ValueError(f"no token ends at byte {len(last) + 1}: a single byte is missing")
        return self

    def cut(self, length: int) -> Prefixes:
        """Back to a shorter prefix: what an edit behind it leaves valid."""
        self.piece = self.piece[:length]
        del self.last[length:]
        return self

    def tokens(self) -> list[int]:
        found, end = [], len(self.piece)
        while end:
            token = self.last[end - 1]
            found.append(token)
            end -= len(self.vocabulary.bytes_of[token])
        return found[::-1]


class Pieces(dict):
    """Token ids of pieces as 32-bit numbers, encoded when first asked for; short pieces are remembered.

    When they are too many, those not asked for since the last time there were are forgotten.
    """

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            raw = piece.encode()
            whole = self.vocabulary.ranks.get(raw)
            found = [whole] if whole is not None else Prefixes(self.vocabulary, raw).tokens()
            ids = np.array(found, np.int32).tobytes()
        if len(piece) < 64:  # longer ones hardly recur; they are encoded anew
            if len(self) >= KEPT_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


def _looked_up(table: list, ids: list[int]) -> tuple:
    """The table's entries for the ids, in their order."""
    return itemgetter(*ids)(table) if len(ids) > 1 else tuple(table[i] for i in ids)


@dataclass
class Codec:
    """Texts to token ids and back."""

    vocabulary: Vocabulary
    pattern: str

    def __post_init__(self):
        self._split = regex.compile(self.pattern)
        self._pieces = Pieces(self.vocabulary)
        bytes_of = self.vocabulary.bytes_of
        ranks = range(max(bytes_of, default=-1) + 1)
        self._bytes = [bytes_of.get(rank) for rank in ranks]
        self._names = [str(rank) for rank in ranks]

    def packed(self, text: str) -> bytes:
        """The ids as 32-bit numbers."""
        return b"".join(map(self._pieces.__getitem__, self._split.findall(text)))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), np.int32).tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(_looked_up(self._bytes, ids))

    def listed(self, ids: list[int]) -> str:
        """The ids in decimal, joined by commas."""
        return ",".join(_looked_up(self._names, ids))


_codecs: dict[tuple[str, str], Codec] = {}


def _codec(ranks_file: str, pattern: str) -> Codec:
    """One codec per worker process, so that tasks share what it remembers."""
    if (ranks_file, pattern) not in _codecs:
        path = SparkFiles.get(ranks_file)
        _codecs[(ranks_file, pattern)] = Codec(Vocabulary(read_ranks(path)), pattern)
    return _codecs[(ranks_file, pattern)]


def _runs(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows that have up to ``RUN_BYTES`` in a column of texts, beside a run's first one.

    A batch may have any number of rows, and the ids of all its texts would take many times their bytes.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    run = np.cumsum(sizes, dtype=np.int64) // RUN_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for start, stop in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(start, stop - start)


def _ship(docs: DataFrame, ranks_path: str) -> str:
    """Sends the rank file to the executors; returns its name there."""
    docs.sparkSession.sparkContext.addFile(ranks_path)
    return ranks_path.rsplit("/", 1)[-1]


def encode_texts(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``token_ids``, the ids of the whole text."""
    name = _ship(docs, ranks_path)
    columns = [c for c in docs.columns if c != "token_ids"]

    at = columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(name, pattern)
        for some in (some for batch in batches for some in _runs(batch, at)):
            packed = [codec.packed(value.as_py() or "") for value in some.column(at)]
            ends = np.cumsum([0, *(len(ids) // 4 for ids in packed)], dtype=np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), np.int32)))
            yield pa.RecordBatch.from_arrays([*some.columns, ids], [*columns, "token_ids"])

    kept = docs.select(*columns)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(run, f"{schema}, token_ids array<int>")


def round_trips(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """Per document the number of ids, a digest of the ids and a digest of the bytes they decode to."""
    name = _ship(docs, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(name, pattern)
        for batch in batches:
            out: list[list] = [[], [], []]
            for value in batch.column(1):
                ids = codec.encode(value.as_py() or "")
                out[0].append(len(ids))
                out[1].append(hashlib.sha256(codec.listed(ids).encode()).hexdigest())
                out[2].append(hashlib.sha256(codec.decode(ids)).hexdigest())
            arrays = [batch.column(0), pa.array(out[0], pa.int64()), *(pa.array(x, pa.string()) for x in out[1:])]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", text).mapInArrow(run, ENCODED)
