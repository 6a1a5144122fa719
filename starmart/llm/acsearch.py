"""Ranked lexical search: one Aho-Corasick automaton of all items' terms reads every text once.

There is no index of the documents. Terms are maximal runs of digits, letters and characters beyond
ASCII; A-Z count as a-z. In the automaton each term stands between two boundary marks, and in a text
every other ASCII character is such a mark, so only whole terms match, and the outputs of one walk over
the text are its term counts. Each output stands for the items that hold the term.

1. ``term_pairs``: the distinct (item, term) pairs, dealt into blocks of bounded size. A block's terms
   are sent to the tasks as one automaton; more items mean more blocks, each with its own pass.
2. ``scan``: length and term counts of every document, stored in the shared folder.
3. Document frequencies, number and length of documents come from that table; weights are one row per
   term of the block.
4. ``best``: each task adds up the scores of its documents and keeps the ``k`` best of every item, so
   what is shuffled is ``k`` rows per item and task. Those are ranked in two steps, first dealt by task,
   so no item's rows of all tasks meet in one.

The score is the sum of ``w * ((10^9 tf) div (1000 tf + 8 m))`` over the item's terms, with
``w = floor(1000 ln((2N + 2) / (2 df + 1)))`` and ``m = 10 + (90 n N) div L``, all but the logarithm in
64-bit integers.

Defined results: a null or empty text, of a document or an item, has no terms; such a document is not
counted and such an item has no rows. Rows of items with the same id, nulls included, are one item with
the terms of all; repeated documents are documents of their own, each with a rank. Equal scores go by
ascending doc_id, null last. Empty tables give no rows. Texts of any length are read whole; columns other
than id and text are not used, whatever their names.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.common import LOWER, UPPER, forget, stored, whole_text

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
MARK = "\0"
#: The bytes of a UTF-8 text: A-Z in lower case, every other ASCII byte outside terms is the mark.
BYTES = bytes(
    b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 0 for b in range(256)
)

#: Bounds of one block of items, sent to every task. An item is never split.
BLOCK_BYTES = 16 * 1024 * 1024
BLOCK_ITEMS = 20_000
PAIR_BYTES = 64  # charged for a pair on top of its text
CELLS = 2_000_000  # scores or postings held at once by a task
DEALS = 256

HITS = "doc_id bigint, n bigint, terms array<int>, tfs array<bigint>"
BEST = "item int, doc_id bigint, score bigint, deal int"


def guarded(term: str) -> str:
    """A term between marks, its UTF-8 bytes written as Latin-1, as the texts are read."""
    return f"{MARK}{term.encode().decode('latin-1')}{MARK}"


def as_read(text: str) -> bytes:
    return b"\0" + text.encode().translate(BYTES) + b"\0"


def automaton_of(terms: list[str]) -> ahocorasick.Automaton:
    """Finds the number of each term at its end mark."""
    automaton = ahocorasick.Automaton()
    for number, term in enumerate(terms):
        automaton.add_word(guarded(term), number)
    automaton.make_automaton()
    return automaton


def n_terms(raw: bytes) -> int:
    inside = np.frombuffer(raw, np.uint8) != 0
    return int(np.count_nonzero(inside[1:] & ~inside[:-1]))


def term_pairs(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``(item_id, term)``, each once."""
    lowered = F.translate(whole_text(text), UPPER, LOWER)
    terms = F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))
    return items.select(F.col(item_id).alias("item_id"), F.explode(F.array_distinct(terms)).alias("term")).distinct()


def _block(blocks: int):
    return F.pmod(F.xxhash64("item_id"), F.lit(blocks))


def _blocks(pairs: DataFrame) -> int:
    """How many blocks keep each within its bounds, or to one item."""
    cost = F.octet_length("term") + F.lit(PAIR_BYTES)
    per_item = pairs.groupBy("item_id").agg(F.sum(cost).alias("bytes"))
    blocks = 1
    while True:
        sizes = per_item.groupBy(_block(blocks).alias("block")).agg(
            F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("items")
        )
        over = sizes.filter((F.col("items") > 1) & ((F.col("bytes") > BLOCK_BYTES) | (F.col("items") > BLOCK_ITEMS)))
        if over.isEmpty():
            return blocks
        blocks *= 2


_automata: dict[str, ahocorasick.Automaton] = {}


def scan(docs: DataFrame, terms: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its number of terms, and which of ``terms`` (at least one) it has
    how often; documents without terms have no row."""
    sent = docs.sparkSession.sparkContext.broadcast(automaton_of(terms))
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _automata:
            _automata.clear()
            _automata[key] = sent.value
        for batch in batches:
            ids, lengths, found, counts = [], [], [], []
            for doc, value in zip(batch.column(0), batch.column(1), strict=True):
                raw = as_read(value.as_py() or "")
                n = n_terms(raw)
                if not n:
                    continue
                tf = Counter(map(itemgetter(1), _automata[key].iter(raw.decode("latin-1"))))
                ids.append(doc.as_py())
                lengths.append(n)
                found.append(list(tf))
                counts.append(list(tf.values()))
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()))
            arrays = [pa.array(v, k) for v, k in zip((ids, lengths, found, counts), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n", "terms", "tfs"])

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, HITS)


class Postings:
    """For each term its weight and the items that hold it."""

    def __init__(self, weights: np.ndarray, pairs: list[tuple[int, int]], items: int):
        terms = np.array([t for t, _ in pairs], np.int64)
        order = np.argsort(terms, kind="stable")
        self.items_of = np.array([i for _, i in pairs], np.int64)[order]
        self.start = np.searchsorted(terms[order], np.arange(len(weights) + 1))
        self.weights = weights
        self.items = items

    def fan_out(self, terms: np.ndarray) -> np.ndarray:
        return self.start[terms + 1] - self.start[terms]

    def scores(self, rows: np.ndarray, terms: np.ndarray, parts: np.ndarray, height: int) -> np.ndarray:
        """``height x items`` sums of weight times part over the items of each (row, term)."""
        fan = self.fan_out(terms)
        at = np.repeat(np.arange(len(terms)), fan)
        offset = np.arange(len(at)) - np.repeat(np.cumsum(fan) - fan, fan)
        cells = rows[at] * self.items + self.items_of[self.start[terms][at] + offset]
        sums = np.zeros(height * self.items, np.int64)
        np.add.at(sums, cells, (self.weights[terms] * parts)[at])
        return sums.reshape(height, self.items)


class Best:
    """The ``k`` best documents of each item so far: highest score, then smallest id, null last."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.least = np.ones(items, np.int64)  # a score below it cannot enter
        self.item, self.score, self.doc = (np.empty(0, np.int64) for _ in range(3))
        self.null = np.empty(0, bool)

    def add(self, scores: np.ndarray, docs: np.ndarray, nulls: np.ndarray) -> None:
        row, item = np.nonzero(scores >= self.least)
        item = np.concatenate([self.item, item])
        score = np.concatenate([self.score, scores[row, item[len(self.item) :]]])
        doc, null = np.concatenate([self.doc, docs[row]]), np.concatenate([self.null, nulls[row]])
        order = np.lexsort((doc, null, -score, item))
        place = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        kept = order[place < self.k]
        self.item, self.score, self.doc, self.null = item[kept], score[kept], doc[kept], null[kept]
        last = order[place == self.k - 1]
        self.least[item[last]] = score[last]


def length_parts(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """``m`` of documents with ``n`` terms; the product is taken in wider integers where it needs them."""
    wide = 90 * documents * int(n.max(initial=0)) >= 1 << 63
    return (10 + (90 * documents * (n.astype(object) if wide else n)) // terms).astype(np.int64)


def best(hits: DataFrame, postings: Postings, documents: int, length: int, k: int) -> DataFrame:
    """The ``k`` best documents of each item among those of each task."""
    sent = hits.sparkSession.sparkContext.broadcast(postings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        found = Best(index.items, k)
        for batch in batches:
            ids, terms = batch.column(0), batch.column(2)
            docs, nulls = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
            m = length_parts(batch.column(1).to_numpy(), documents, length)
            sizes = np.diff(terms.offsets.to_numpy())
            rows = np.repeat(np.arange(len(sizes)), sizes)
            flat, tf = terms.flatten().to_numpy().astype(np.int64), batch.column(3).flatten().to_numpy()
            parts = (1_000_000_000 * tf) // (1000 * tf + 8 * m[rows])
            cost = np.full(len(sizes), index.items, np.int64)
            np.add.at(cost, rows, index.fan_out(flat))
            chunk = np.cumsum(cost) // CELLS
            first = np.concatenate([[0], np.cumsum(sizes)])
            cuts = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(sizes)]
            for low, high in zip(cuts, cuts[1:], strict=False):
                some = slice(first[low], first[high])
                scores = index.scores(rows[some] - low, flat[some], parts[some], high - low)
                found.add(scores, docs[low:high], nulls[low:high])
        deal = TaskContext.get().partitionId() % DEALS
        arrays = [
            pa.array(found.item, pa.int32()),
            pa.array(found.doc, pa.int64(), mask=found.null),
            pa.array(found.score, pa.int64()),
            pa.array(np.full(len(found.item), deal), pa.int32()),
        ]
        yield pa.RecordBatch.from_arrays(arrays, ["item", "doc_id", "score", "deal"])

    return hits.mapInArrow(run, BEST)


def _ranked(rows: DataFrame, k: int, *group: str) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _block_best(docs: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """``(item_id, doc_id, score)``: the best documents of the items of one block."""
    spark = docs.sparkSession
    rows = pairs.select("item_id", "term").collect()  # within BLOCK_BYTES
    if not rows:
        kind = pairs.schema["item_id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    items = list(dict.fromkeys(r.item_id for r in rows))
    terms = sorted({r.term for r in rows})
    number, place = {t: i for i, t in enumerate(terms)}, {x: i for i, x in enumerate(items)}
    hits = stored(scan(docs, terms), "term-counts")
    whole = hits.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("length")).first()
    holding = hits.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    share = F.lit(2 * whole.documents + 2) / (2 * F.col("df") + 1)
    weights = np.zeros(len(terms), np.int64)
    for row in holding.select("term", F.floor(1000 * F.log(share)).alias("w")).toLocalIterator():
        weights[row.term] = row.w
    postings = Postings(weights, [(number[r.term], place[r.item_id]) for r in rows], len(items))
    found = stored(_ranked(best(hits, postings, whole.documents, whole.length or 1, k), k, "item", "deal"), "best")
    forget(hits)
    schema = T.StructType([T.StructField("item", T.IntegerType()), pairs.schema["item_id"]])
    names = spark.createDataFrame(list(enumerate(items)), schema)
    return _ranked(found.drop("rank"), k, "item").join(names, "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents of each item, with a score above 0."""
    pairs = stored(term_pairs(items), "item-terms")
    blocks = _blocks(pairs)
    parts = [_block_best(docs, pairs.filter(_block(blocks) == b), k) for b in range(blocks)]
    return reduce(DataFrame.unionByName, parts)
