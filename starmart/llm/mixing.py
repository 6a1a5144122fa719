"""Mixing sources to target weights, by blocks of tokens.

1. Each source's documents, in a fixed pseudorandom order, are one stream of words, packed into blocks
   of ``BLOCK`` words (the last one may be shorter).
2. Targets follow the weights and stop at ``MOST`` times a source's size; the excess is shared again.
   A source's target in blocks is its number of slots.
3. Every output shard draws how many of its slots each source gets from a multinomial with the slots'
   shares. Numbered through over the shards, a source can come out with a few slots more or fewer than
   planned; the slots too many, in order, are handed to the sources with too few.
4. The n-th slot of a source holds the block that a keyed permutation of the source's block numbers
   gives for n, with a new permutation for every full round. So every block is taken once before any is
   taken twice, and none more than ``MOST`` times.
5. Slots are joined with the documents by source and block.

The order within a source comes from a hash that splits each source into ``CHUNKS``; offsets are sums
over chunks and over the documents of one chunk, so a hot source is never summed in one task. The draw
of a shard depends on the seed and its number only: reruns and recomputed tasks agree.

One row per source is planned on the driver, at most ``MOST_SOURCES``.

Defined results: a null text has no words, takes none and changes nothing; null is a source of its own,
last in order; rows repeated in all columns are documents of their own; without any words nothing is
taken and targets are 0. Columns of the input beyond doc_id, text and source are not used.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import PYTHON_WORD, stored, whole_text, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5  # of all words that the mix holds
MOST = 2
BLOCK = 64
SHARD = 8192  # slots of an output shard
RUN = 1024  # shards whose draws are numbered together
CHUNKS = 4096
MOST_SOURCES = 100_000
SEED = 20_240_601
ROUNDS = 6


def targets(sizes: list[int], weights: list[float], share: float = SHARE, most: int = MOST) -> list[float]:
    """Words per source by weight, none above ``most`` times its size."""
    found = [0.0] * len(sizes)
    rest, open_ = share * sum(sizes), set(range(len(sizes)))
    while open_:
        unit = rest / sum(weights[i] for i in open_)
        above = {i for i in open_ if weights[i] * unit > most * sizes[i]}
        for i in above or open_:
            found[i] = float(most * sizes[i]) if above else weights[i] * unit
        rest -= sum(found[i] for i in above)
        open_ -= above or open_
    return found


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """A keyed permutation of ``0 .. size - 1``: a Feistel network, walked until it is back in range."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = [np.uint64(k) for k in np.random.Philox(key=key).random_raw(ROUNDS)]

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            mix = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            mix = (mix ^ (mix >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mix >> np.uint64(32)) & mask)
        return (left << np.uint64(half)) | right

    out = once(index.astype(np.uint64))
    while len(outside := np.flatnonzero(out >= size)):
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source``, ``size``, a hash of the text and the chunk of every row."""
    mark = F.xxhash64("text")
    rows = docs.select(
        "doc_id", "source", word_count(whole_text()).alias("size"), mark.alias("mark")
    )
    return rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "mark"), F.lit(CHUNKS)).cast("int"))


def plan(rows: DataFrame, weights=WEIGHTS, block: int = BLOCK) -> pd.DataFrame:
    """One row per source, in order: its number, size, target, blocks and slots."""
    order = [F.col("source").isNull(), F.col("source")]
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size")).orderBy(*order)
    sources = totals.limit(MOST_SOURCES + 1).collect()
    if len(sources) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    sizes = [int(r.source_size) for r in sources]
    want = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))])
    blocks = [-(-n // block) for n in sizes]
    slots = [round(t * b / n) if n else 0 for t, b, n in zip(want, blocks, sizes, strict=True)]
    return pd.DataFrame(
        {
            "source": pd.Series([r.source for r in sources], dtype=object),
            "s": range(len(sizes)),
            "source_size": sizes,
            "target": want,
            "blocks": blocks,
            "slots": slots,
        }
    )


def _frame(spark, sources: pd.DataFrame) -> DataFrame:
    schema = "source string, s int, source_size long, target double, blocks long, slots long"
    rows = [tuple(x.item() if hasattr(x, "item") else x for x in r) for r in sources.itertuples(index=False)]
    return stored(spark.createDataFrame(rows, schema).coalesce(1), "sources")


def placed(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with their source's plan and ``start``, the words before them in their source."""
    named = rows.join(sources, rows["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    sums = named.groupBy("s", "chunk").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("s").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("s", "chunk", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    own = (
        Window.partitionBy("s", "chunk")
        .orderBy("doc_id", "mark", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offset = F.coalesce(F.sum("size").over(own), F.lit(0))
    return named.withColumn("offset", offset).join(bases, ["s", "chunk"]).withColumn(
        "start", F.col("base") + F.col("offset")
    )


def slot_blocks(spark, sources: pd.DataFrame, seed: int = SEED) -> DataFrame:
    """``shard``, ``s`` and ``block`` of every slot of the mix."""
    slots, blocks = sources["slots"].to_numpy(np.int64), sources["blocks"].to_numpy(np.int64)
    total = int(slots.sum())
    shares = slots / max(total, 1)

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard in batch["id"]:
                size = min(SHARD, total - shard * SHARD)
                counts = np.random.Generator(np.random.Philox(key=[seed, shard])).multinomial(size, shares)
                drawn = np.flatnonzero(counts)
                yield pd.DataFrame({"shard": shard, "s": drawn, "n": counts[drawn]})

    tasks = max(1, math.ceil(total / SHARD / 16))
    shards = spark.range(0, math.ceil(total / SHARD), 1, tasks)
    drawn = stored(shards.mapInPandas(draw, "shard long, s int, n long"), "draws")
    got = np.zeros(len(slots), np.int64)
    for row in drawn.groupBy("s").agg(F.sum("n").alias("n")).collect():
        got[row.s] = row.n
    # The k-th slot too many, over all sources in order, becomes the k-th one that is missing.
    over, under = np.maximum(got - slots, 0), np.maximum(slots - got, 0)
    over_base, under_ends = np.cumsum(over) - over, np.cumsum(under)

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first in range(0, len(batch), 1000):
                some = batch.iloc[first : first + 1000]
                n = some["n"].to_numpy()
                s = np.repeat(some["s"].to_numpy(np.int64), n)
                nth = np.repeat(some["base"].to_numpy(), n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                extra = nth >= slots[s]
                rank = over_base[s[extra]] + nth[extra] - slots[s[extra]]
                taker = np.searchsorted(under_ends, rank, side="right")
                nth[extra] = got[taker] + rank - (under_ends[taker] - under[taker])
                s[extra] = taker
                block = np.empty(len(s), np.int64)
                turn = nth // blocks[s]
                for source, t in {*zip(s.tolist(), turn.tolist(), strict=True)}:
                    own = (s == source) & (turn == t)
                    key = (seed << 64) + (source << 8) + t
                    block[own] = permuted(nth[own] % blocks[source], int(blocks[source]), key)
                shard = np.repeat(some["shard"].to_numpy(), n)
                yield pd.DataFrame({"shard": shard, "s": s, "block": block})

    # Slots are told apart within tasks that hold whole shards, however many a source has.
    numbered = stored(_numbered(drawn), "numbered-draws")
    return numbered.repartition(tasks, "shard").mapInPandas(settle, "shard long, s int, block long")


def _numbered(drawn: DataFrame) -> DataFrame:
    """Draws with ``base``, how many slots of their source the earlier shards drew.

    Summed up over runs of shards first, so no task orders all shards of a source.
    """
    runs = drawn.withColumn("run", F.floor(F.col("shard") / RUN))
    sums = runs.groupBy("s", "run").agg(F.sum("n").alias("of_run"))
    earlier = Window.partitionBy("s").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("s", "run", F.coalesce(F.sum("of_run").over(earlier), F.lit(0)).alias("of_runs"))
    before = Window.partitionBy("s", "run").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    own = runs.withColumn("own", F.coalesce(F.sum("n").over(before), F.lit(0)))
    base = (F.col("of_runs") + F.col("own")).alias("base")
    return own.join(sums, ["s", "run"]).select("shard", "s", "n", base)


def doc_blocks(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows with a word, once for each of their blocks, with the words they have in it."""
    end = F.col("start") + F.col("size")
    numbers = F.sequence(F.floor(F.col("start") / block), F.floor((end - 1) / block))
    return (
        rows.filter("size > 0")
        .withColumn("block", F.explode(numbers))
        .withColumns(
            {
                "from_word": F.greatest(F.lit(0).cast("long"), F.col("block") * block - F.col("start")),
                "to_word": F.least(F.col("size"), (F.col("block") + 1) * block - F.col("start")),
            }
        )
    )


def mix(docs: DataFrame, weights=WEIGHTS, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """Per row of ``docs`` its size, source_size, target, ``taken`` words and the ``parts`` taken.

    ``parts`` lists ``from_word``, ``to_word`` and ``times`` for each block that the mix takes.
    """
    spark = docs.sparkSession
    rows = stored(sized(docs), "sizes")
    sources = plan(rows, weights, block)
    named = stored(placed(rows, _frame(spark, sources)), "placed")
    # Stored, so that Spark plans the join by its real size: it cannot guess how many rows a draw makes.
    times = slot_blocks(spark, sources, seed).groupBy("s", "block").agg(F.count(F.lit(1)).alias("times"))
    met = doc_blocks(named, block).join(stored(times, "times"), ["s", "block"], "left")
    columns = ["doc_id", "mark", "size", "source_size", "target"]
    words = (F.col("to_word") - F.col("from_word")) * F.coalesce("times", F.lit(0))
    part = F.when(F.col("times") > 0, F.struct("from_word", "to_word", "times"))
    taken = met.groupBy("s", "start", *columns).agg(
        F.sum(words).alias("taken"), F.array_sort(F.collect_list(part)).alias("parts")
    )
    empty = named.filter("size = 0").select(
        *columns,
        F.lit(0).cast("long").alias("taken"),
        F.array().cast(taken.schema["parts"].dataType).alias("parts"),
    )
    return taken.select(*empty.columns).union(empty)


def _cut(text: str, parts: list, turn: int) -> str:
    """The stretches of the text that are taken ``turn`` times or more; all of it as it is."""
    spans = [m.span() for m in PYTHON_WORD.finditer(text)]
    runs: list[list[int]] = []
    for part in parts:
        if part["times"] >= turn:
            if runs and runs[-1][1] == part["from_word"]:
                runs[-1][1] = part["to_word"]
            else:
                runs.append([part["from_word"], part["to_word"]])
    if runs == [[0, len(spans)]]:
        return text
    return "\n".join(text[spans[a][0] : spans[b - 1][1]] for a, b in runs)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: each as often as its most taken block, with the words taken that often.

    Columns are those of ``docs``; rows with the same doc_id and text share one decision.
    """
    found = mix(docs, **options).filter("taken > 0").select("doc_id", "mark", "parts")
    decisions = stored(found.dropDuplicates(["doc_id", "mark"]), "decisions")
    same = docs["doc_id"].eqNullSafe(decisions["doc_id"]) & (F.xxhash64(docs["text"]) == decisions["mark"])
    columns = docs.columns
    parts = docs.join(decisions, same).select(*(docs[c] for c in columns), decisions["parts"].alias("_parts"))
    turns = F.sequence(F.lit(1), F.array_max(F.transform("_parts", lambda p: p["times"])).cast("int"))

    @F.pandas_udf("string")
    def cut(texts: pd.Series, taken: pd.Series, turn: pd.Series) -> pd.Series:
        return pd.Series([_cut(*row) for row in zip(texts, taken, turn, strict=True)])

    text = cut("text", "_parts", "_turn")
    out = parts.withColumn("_turn", F.explode(turns)).withColumn("text", text)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*columns)
