"""Lempel-Ziv phrase fingerprints: phrases of an LZ78 parse, hashed; the smallest hashes are kept.

The parse cuts the text where the current stretch is not yet a phrase; each phrase is an earlier one
and one character more. A fingerprint is the ``SIZE`` smallest different phrase hashes, a sample that
is the same function of the phrase set everywhere, so the share of common hashes among the smallest
of two fingerprints estimates the Jaccard likeness of the phrase sets: high where the texts compress
well together.

Neighbouring rows (``with_next``) are met by one shuffle of the texts: rows go to ranges of doc_id, cut
at ids of the table, and the rows at a cut also go to the range before, whose last row needs them.

Defined results: a null text is the empty text; a text without phrases has the empty fingerprint, and
two empty ones are alike (1), one empty one is not (0). Rows are ordered by doc_id downwards, null
last, then by text; the row after the last is the first, so a single row follows itself. Texts of any
length are parsed whole. Columns other than doc_id and text are not used, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import shuffle_partitions, whole_text

SIZE = 128
HEX = 8  # digits of a hash in the fingerprint

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of a factor modulo 2**64, as many as asked for."""

    def __init__(self, factor: np.uint64):
        self.factor, self.known = factor, np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if n > len(self.known):
            steps = np.full(max(n, 2 * len(self.known)), self.factor, np.uint64)
            steps[0] = 1
            self.known = np.multiply.accumulate(steps)
        return self.known[:n]


_UP, _DOWN = _Powers(_FACTOR), _Powers(_INVERSE)


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


class Parse:
    """An LZ78 parse that can be copied and continued."""

    def __init__(self):
        self.nodes: dict[int, int] = {}
        self.ends: list[int] = []
        self.node = 0
        self.at = 0

    def copy(self) -> Parse:
        other = Parse()
        other.nodes, other.ends = self.nodes.copy(), self.ends.copy()
        other.node, other.at = self.node, self.at
        return other

    def read(self, codes: list[int]) -> Parse:
        nodes, ends, node, at = self.nodes, self.ends, self.node, self.at
        step = nodes.get
        for at, code in enumerate(codes, at + 1):  # noqa: B020
            key = node | code
            node = step(key)
            if node is None:
                ends.append(at)
                nodes[key] = len(ends) << 21  # above any code point
                node = 0
        self.node, self.at = node, at
        return self


def smallest_hashes(codes: np.ndarray, ends: list[int], size: int = SIZE) -> np.ndarray:
    """The smallest different hashes of the phrases that end at ``ends``, in order."""
    if not ends:
        return np.empty(0, np.uint32)
    stops = np.array(ends, np.int64)
    starts = np.concatenate([[0], stops[:-1]])
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_mixed(codes.astype(np.uint64) + _FACTOR) * _UP.upto(len(codes)), out=sums[1:])
    own = (sums[stops] - sums[starts]) * _DOWN.upto(len(codes) + 1)[starts]
    hashes = (_mixed(own) >> np.uint64(32)).astype(np.uint32)
    if len(hashes) > 4 * size:
        # Phrases differ, their short hashes almost always: a few more than needed hold enough.
        head = np.unique(np.partition(hashes, 2 * size)[: 2 * size])
        if len(head) >= size:
            return head[:size]
    return np.unique(hashes)[:size]


def fingerprint(hashes: np.ndarray) -> str:
    return hashes.astype(">u4").tobytes().hex()


def hashes_of(print_: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(print_), ">u4").astype(np.uint32)


def text_hashes(text: str, size: int = SIZE) -> np.ndarray:
    codes = codes_of(text)
    return smallest_hashes(codes, Parse().read(codes.tolist()).ends, size)


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Share of common hashes among the smallest of both."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.union1d(a, b)[:size]
    common = np.intersect1d(a, b, assume_unique=True)
    return float(np.count_nonzero(common <= both[-1])) / len(both)


def edited(text: str, following: str) -> tuple[str, int]:
    """The text with its last third replaced by the start of another, and where the change begins."""
    cut = len(text) - len(text) // 3
    return text[:cut] + following[: len(text) // 3], cut


def fingerprints(docs: DataFrame, text: str = "text", size: int = SIZE) -> DataFrame:
    """``docs`` with the column ``fingerprint`` of the whole text."""
    columns = [c for c in docs.columns if c != "fingerprint"]
    kept = docs.select(*columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(columns.index(text)).to_pylist()
            prints = pa.array([fingerprint(text_hashes(t or "", size)) for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, prints], [*columns, "fingerprint"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(run, f"{schema}, fingerprint string")


def _cuts(docs: DataFrame, ranges: int) -> list[int]:
    """Ids of the table, downwards, that begin the ranges; the largest id is the first."""
    shares = [i / ranges for i in range(1, ranges)] or [0.5]
    row = docs.agg(
        F.max("doc_id").alias("top"),
        F.percentile_approx("doc_id", shares, max(10_000, 20 * ranges)).alias("cuts"),
    ).first()
    if row["top"] is None:
        return []
    return sorted({row["top"], *row["cuts"]}, reverse=True)


def with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Rows sorted within ranges of doc_id, with ``range`` and ``borrowed``.

    A borrowed row belongs to the range behind, or to the first range for the last one; the first
    borrowed row, at the end of a range, is the row that follows the range's own last one.
    """
    rows = docs.select("doc_id", whole_text().alias("text"))
    ranges = ranges or shuffle_partitions(docs.sparkSession)
    cuts = _cuts(docs, ranges)
    last = max(len(cuts) - 1, 0)
    downwards = -np.array(cuts, np.int64)

    @F.pandas_udf("array<int>")
    def ranges_of(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        values = ids.fillna(0).astype(np.int64).to_numpy() if len(ids) else np.empty(0, np.int64)
        own = np.where(known, np.searchsorted(downwards, -values, side="right") - 1, last)
        is_cut = known & np.isin(-values, downwards)
        before = np.where(own == 0, last, own - 1)
        return pd.Series([[o, b] if c else [o] for o, b, c in zip(own, before, is_cut, strict=True)])

    if cuts:
        placed = rows.select("doc_id", "text", F.posexplode(ranges_of("doc_id")).alias("copy", "range"))
    else:  # only null ids or no rows: one range that borrows all its rows
        copies = F.array(F.lit(0), F.lit(0))
        placed = rows.select("doc_id", "text", F.posexplode(copies).alias("copy", "range"))
    placed = placed.withColumn("borrowed", F.col("copy") > 0).drop("copy")
    return placed.repartitionById(last + 1, F.col("range")).sortWithinPartitions(
        "range", "borrowed", F.col("doc_id").desc_nulls_last(), "text"
    )


COMPARED = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        owed = batch.column("borrowed").to_pylist()
        places = batch.column("range").to_pylist()
        for i, text in enumerate(batch.column("text")):
            yield places[i], owed[i], ids[i], text.as_py()


def _own_with_next(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Own rows with the text after them; the borrowed rows behind the first are passed over."""
    before = None
    for row in rows:
        if before is not None and before[0] == row[0] and not before[1]:
            yield before[2], before[3], row[3]
        before = row


def compared(docs: DataFrame, size: int = SIZE, ranges: int | None = None) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness to each other and the next."""

    def prints(text: str, following: str) -> tuple[str, np.ndarray, np.ndarray]:
        """The edited text's digest and the hashes of both; their common start is parsed once."""
        changed, cut = edited(text, following)
        codes, new = codes_of(text), codes_of(changed)
        parse = Parse().read(codes[:cut].tolist())
        other = parse.copy().read(new[cut:].tolist())
        own = smallest_hashes(codes, parse.read(codes[cut:].tolist()).ends, size)
        digest = hashlib.sha256(changed.encode()).hexdigest()
        return digest, own, smallest_hashes(new, other.ends, size)

    def results(rows: Iterator[tuple]) -> Iterator[tuple]:
        """A row is complete once the next one's hashes are known, mostly as those of the next row."""

        def complete(follower: np.ndarray) -> tuple:
            doc_id, text, _, (digest, own, other) = waiting
            near = likeness(own, other, size), likeness(own, follower, size)
            return (doc_id, len(text), digest, fingerprint(own), fingerprint(other), *near)

        waiting = None
        for doc_id, text, following in rows:
            found = prints(text, following)
            if waiting:
                yield complete(found[1] if waiting[2] == text else text_hashes(waiting[2], size))
            waiting = doc_id, text, following, found
        if waiting:
            yield complete(text_hashes(waiting[2], size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in COMPARED.split(", ")]
        kinds = [pa.int64()] * 2 + [pa.string()] * 3 + [pa.float64()] * 2
        done = results(_own_with_next(_rows(batches)))
        while chunk := list(islice(done, 1000)):
            columns = zip(*chunk, strict=True)
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return with_next(docs, ranges).mapInArrow(run, COMPARED)
