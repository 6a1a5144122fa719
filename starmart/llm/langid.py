"""Language by cross-parsing: how few phrases of a language's known text does a text need.

Each language has a suffix automaton of a bounded sample of its labelled text. A text is cut, from left
to right, into the longest stretches the automaton knows; fewer phrases per character mean a closer
language. The language with the fewest normalised phrases wins.

Texts are lower-cased and everything but letters becomes one blank. So that whole batches walk the
automata in step, a text is read in stretches of ``STRETCH`` characters, each a parse of its own; every
character of every text is read.

The automata are learned on the driver from at most ``SAMPLE_ROWS`` rows and ``SAMPLE_CHARS`` characters
per language and at most ``MOST_LANGUAGES`` languages, so what is sent out has a fixed size bound.

Defined results: ``und`` with score 0 for a null text, a text without a letter, or nothing learned; ties
go to the language first by code point. A row without label or id is never learned from. Input columns
stay, but for ``lang_pred`` and ``score``, which are replaced. Repeated rows give repeated results.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
SAMPLE_ROWS = 64
SAMPLE_CHARS = 60_000
MOST_LANGUAGES = 100
STRETCH = 512
SHARPNESS = 60.0
DENSE_LETTERS = 256  # wider alphabets are looked up by search instead of a table
ROOT = 1

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def normal(text: str) -> str:
    """Lower-case letters with single blanks between; empty if there is no letter."""
    return _NOT_LETTERS.sub(" ", text.lower()).strip()


def suffix_automaton(text: str) -> list[dict[str, int]]:
    """Transitions of the states; state 0 is unused, 1 is the root."""
    step: list[dict[str, int]] = [{}, {}]
    link, length, last = [0, 0], [0, 0], ROOT
    for c in text:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(ROOT)
        at = last
        while at and c not in step[at]:
            step[at][c] = new
            at = link[at]
        if at:
            target = step[at][c]
            if length[at] + 1 == length[target]:
                link[new] = target
            else:
                twin = len(step)
                step.append(dict(step[target]))
                length.append(length[at] + 1)
                link.append(link[target])
                while at and step[at].get(c) == target:
                    step[at][c] = twin
                    at = link[at]
                link[target] = link[new] = twin
        last = new
    return step


class Steps:
    """Next states by state and letter, 0 where there is none."""

    def __init__(self, states: int, arrows: np.ndarray, width: int):
        self.width = width
        keys = arrows[:, 0].astype(np.int64) * width + arrows[:, 1]
        self.table = self.keys = None
        if width <= DENSE_LETTERS:
            self.table = np.zeros(states * width, np.int32)
            self.table[keys] = arrows[:, 2]
        else:
            order = np.argsort(keys)
            self.keys = np.append(keys[order], np.iinfo(np.int64).max)
            self.targets = np.append(arrows[order, 2], 0)

    def next(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        key = state * self.width + letter
        if self.table is not None:
            return self.table[key].astype(np.int64)
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.targets[at], 0).astype(np.int64)


@dataclass
class Automata:
    """All languages' automata over one alphabet, as lists of transitions."""

    languages: list[str]
    alphabet: str
    states: list[int]
    arrows: list[np.ndarray]  # per language rows of state, letter, next state

    def steps(self) -> list[Steps]:
        width = len(self.alphabet) + 1  # letter 0 is any other character
        return [Steps(n, a, width) for n, a in zip(self.states, self.arrows, strict=True)]


def learn(samples: dict[str, str]) -> Automata:
    languages = sorted(samples)
    alphabet = "".join(sorted(set("".join(samples.values()))))
    letter = {c: i + 1 for i, c in enumerate(alphabet)}
    automata = [suffix_automaton(samples[name]) for name in languages]
    arrows = [
        np.array([(s, letter[c], t) for s, step in enumerate(a) for c, t in step.items()], np.int32).reshape(-1, 3)
        for a in automata
    ]
    return Automata(languages, alphabet, [len(a) for a in automata], arrows)


class Parser:
    """Counts phrases of normalised texts in every language at once."""

    def __init__(self, automata: Automata):
        self.languages = automata.languages
        self.steps = automata.steps()
        self.letters = np.zeros(0x110000, np.int32)
        for i, c in enumerate(automata.alphabet):
            self.letters[ord(c)] = i + 1

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrases per text and language; the last, unfinished phrase of a stretch counts as one."""
        sizes = np.array([len(t) for t in texts], np.int64)
        codes = self.letters[np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)]
        pieces = -(-sizes // STRETCH)
        owner = np.repeat(np.arange(len(texts)), pieces)
        first = np.cumsum(sizes) - sizes
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts = first[owner] + nth * STRETCH
        lengths = np.minimum(STRETCH, sizes[owner] - nth * STRETCH)
        order = np.argsort(-lengths, kind="stable")
        owner, starts, lengths = owner[order], starts[order], lengths[order]
        counts = np.zeros((len(texts), len(self.steps)), np.int64)
        for number, steps in enumerate(self.steps):
            found = self._walk(steps, codes, starts, lengths)
            counts[:, number] = np.bincount(owner, found, len(texts))
        return counts

    def _walk(self, steps: Steps, codes, starts, lengths) -> np.ndarray:
        state = np.full(len(starts), ROOT, np.int64)
        count = np.zeros(len(starts), np.int64)
        every = np.arange(steps.width)
        root = np.maximum(steps.next(np.full(steps.width, ROOT), every), ROOT)
        live = len(starts)
        for i in range(int(lengths[0]) if live else 0):
            while lengths[live - 1] <= i:  # sorted by length: the short ones are done first
                live -= 1
            letter = codes[starts[:live] + i]
            reached = steps.next(state[:live], letter)
            stopped = reached == 0
            count[:live] += stopped
            # The phrase ends before this letter, which begins the next one if it is known at all.
            state[:live] = np.where(stopped, root[letter], reached)
        return count + 1

    def judge(self, texts: list[str | None]) -> list[tuple[str, float]]:
        plain = [normal(t or "") for t in texts]
        if not self.languages:
            return [(UNKNOWN, 0.0)] * len(texts)
        asked = [i for i, t in enumerate(plain) if t]
        out = [(UNKNOWN, 0.0)] * len(texts)
        for at in range(0, len(asked), 2000):
            some = asked[at : at + 2000]
            counts = self.phrases([plain[i] for i in some])
            rates = counts / np.array([[len(plain[i])] for i in some])
            weights = np.exp(-SHARPNESS * (rates - rates.min(axis=1, keepdims=True)))
            scores = weights.max(axis=1) / weights.sum(axis=1)
            for i, best, score in zip(some, rates.argmin(axis=1), scores, strict=True):
                out[i] = self.languages[best], float(score)
        return out


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document must not be learned from; a row without id counts as not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame) -> dict[str, str]:
    """Up to ``SAMPLE_CHARS`` normalised characters per language, from rows in hash order of their id."""
    labelled = docs.filter(
        (F.crc32(F.col("doc_id").cast("string")) % 3 != 1) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    )
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), F.xxhash64("text"))
    picked = labelled.select(
        "lang", F.substring("text", 1, SAMPLE_CHARS).alias("text"), F.row_number().over(order).alias("n")
    ).filter(F.col("n") <= SAMPLE_ROWS)
    before = Window.partitionBy("lang").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    taken = F.coalesce(F.sum(F.length("text")).over(before), F.lit(0))
    picked = picked.withColumn("taken", taken).filter(F.col("taken") < 2 * SAMPLE_CHARS)
    texts: dict[str, list[str]] = {}
    left: dict[str, int] = {}
    for row in picked.orderBy("lang", "n").toLocalIterator():
        room = left.setdefault(row.lang, SAMPLE_CHARS)
        text = normal(row.text)[:room]
        left[row.lang] = room - len(text)
        texts.setdefault(row.lang, []).append(text)
        if len(texts) > MOST_LANGUAGES:
            raise ValueError(f"more than {MOST_LANGUAGES} languages are labelled")
    return {lang: " ".join(t for t in parts if t) for lang, parts in texts.items()}


_parsers: dict[str, Parser] = {}


def identify(docs: DataFrame, automata: Automata, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(automata)
    key = uuid.uuid4().hex
    columns = [c for c in docs.columns if c not in ("lang_pred", "score")]
    kept = docs.select(*columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _parsers:
            _parsers.clear()
            _parsers[key] = Parser(model.value)
        for batch in batches:
            judged = _parsers[key].judge(batch.column(columns.index(text)).to_pylist())
            names = pa.array([name for name, _ in judged], pa.string())
            scores = pa.array([score for _, score in judged], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, names, scores], [*columns, "lang_pred", "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(run, f"{schema}, lang_pred string, score double")
