"""Near duplicates: documents whose five-word shingle sets have a Jaccard likeness of 0.75 or more.

The components are those of all pairs at or above the likeness; pairs inside a component that is already
known are not verified, and links are not counted or returned. The steps, each over all documents:

1. Equal sets become one node, named by a digest of the set. Its count vector has about four shingles a
   group, so it tells large sets apart as well as small ones.
2. Shingles that many documents have are found by counting (``hot_shingles``); they only move to the end
   of the order in which the next step takes shingles, which any common order makes exact.
3. Two linked sets share one of the first ``n - ceil(0.75 n) + 1`` shingles of each. Nodes that share one
   form a block; blocks with the same nodes are kept once.
4. Stars, for the nodes of large blocks: each is compared with one hub of its blocks, a few times with
   other hubs while that finds many links. Large groups of copies fall together, and blocks within one
   component need nothing more.
5. In each block left, an R-tree over count vectors finds the pairs of different components that can
   link at all. Of these a task returns a spanning forest, fewer rows than nodes. Blocks beyond ``CHUNK``
   nodes are cut into chunks that meet pairwise, so no task holds a whole block.
6. What hangs together by such pairs is a cluster: any two nodes that can link are in one. Only the nodes
   of clusters are read again; the sets of a cluster meet in one task, or pairwise in chunks, and all its
   links between different components are verified there. Of these, too, a spanning forest is returned.

One R-tree over all documents was not usable: a radius of a seventh of two sets' sizes is wider than the
distance of unrelated sets for most sizes and any affordable number of groups, so it would compare
nearly all pairs. Inside the blocks it is cheap and exact.

Defined results: a null or empty text, or one without words, has no shingle and is alone in its
component. A component's id is its smallest doc_id; repeated ids and rows are documents of their own; a
component whose ids are all null has a null id. Input columns other than doc_id and text are not used.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import forget, shuffle_partitions, stored
from starmart.llm.components import components
from starmart.llm.rtree import (
    RTree,
    count_vector,
    folded,
    groups_for,
    may_link,
    overlap_bound,
    packed,
    unpacked,
)
from starmart.llm.shingles import set_digest, shingle_sets
from starmart.operators.lookup import BROADCAST_BYTES, BROADCAST_ROWS

HOT = 32  # documents with a shingle from which it goes to the end of the order
MOST_HOT = 1_000_000  # hottest shingles sent to the tasks, 8 MB; others only keep their usual place
CHUNK = 1000
CHUNK_SHINGLES = 1_000_000  # of the sets of a chunk whose links are verified
LARGE = 8  # nodes of a block from which stars are tried before all its pairs
STARS = 6
FEW_LINKS = 0.02  # links per compared pair below which another star is not worth its round
TOKENS = 1 << 19  # shingles dealt at once
HALF = np.uint64(1 << 63)
LOW = np.uint64(0xFFFFFFFF)


def _parts(docs: DataFrame) -> int:
    return max(shuffle_partitions(docs.sparkSession), docs.rdd.getNumPartitions())


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            some = batch.slice(at, 1000)
            yield some, list(shingle_sets(some.column("text").to_pylist()))


def _low_part(tokens: np.ndarray, parts: int) -> np.ndarray:
    """Part of shingles in the lower half of the numbers."""
    return ((tokens >> np.uint64(31)) * np.uint64(parts)) >> np.uint64(32)


def _hot_key(tokens: np.ndarray, parts: int) -> np.ndarray:
    return (_low_part(tokens, parts) << np.uint64(32)) | (tokens & LOW)


READ = (
    "doc_id bigint, mark bigint, n_shingles bigint, node binary, vector binary, "
    "part int, tokens binary, times binary"
)


def read_texts(docs: DataFrame, parts: int) -> DataFrame:
    """Two kinds of rows from one reading of the texts.

    A document has ``doc_id``, a hash of its text, ``n_shingles``, the node (null without shingles) and
    its count vector. A pile, told by its ``part``, has counted shingles of the lower half.
    """
    names = [field.split()[0] for field in READ.split(", ")]
    kinds = [pa.int64()] * 3 + [pa.binary()] * 2 + [pa.int32()] + [pa.binary()] * 2

    def rows(columns: dict[str, object], n: int) -> pa.RecordBatch:
        arrays = [
            pa.nulls(n, kind) if name not in columns else pa.array(columns[name], kind)
            for name, kind in zip(names, kinds, strict=True)
        ]
        return pa.RecordBatch.from_arrays(arrays, names)

    def documents(batch: pa.RecordBatch, sets: list[np.ndarray]) -> pa.RecordBatch:
        columns = {
            "doc_id": batch.column("doc_id"),
            "mark": batch.column("mark"),
            "n_shingles": [len(s) for s in sets],
            "node": [set_digest(s) if len(s) else None for s in sets],
            "vector": [packed(count_vector(s, groups_for(len(s)))) if len(s) else None for s in sets],
        }
        return rows(columns, len(sets))

    def piles(pile: list[np.ndarray]) -> pa.RecordBatch:
        tokens, times = np.unique(np.concatenate(pile), return_counts=True)
        part = _low_part(tokens, parts)
        cuts = np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))
        short = (tokens & LOW).astype(np.uint32)
        columns: dict[str, list] = {"part": [], "tokens": [], "times": []}
        for p in np.unique(part).tolist():
            own, n = short[cuts[p] : cuts[p + 1]], times[cuts[p] : cuts[p + 1]]
            columns["part"].append(p)
            # Those met once come first and need no count.
            columns["tokens"].append(np.concatenate([own[n == 1], own[n > 1]]).tobytes())
            columns["times"].append(n[n > 1].astype(np.uint32).tobytes())
        return rows(columns, len(columns["part"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pile, size = [], 0
        for batch, sets in _texts(batches):
            yield documents(batch, sets)
            for s in sets:
                pile.append(s[: np.searchsorted(s, HALF)])
                size += len(pile[-1])
            if size >= TOKENS:
                yield piles(pile)
                pile, size = [], 0
        if size:
            yield piles(pile)

    return docs.select("doc_id", "text", F.xxhash64("text").alias("mark")).mapInArrow(run, READ)


def hot_shingles(read: DataFrame, parts: int) -> np.ndarray:
    """Keys of the shingles of the lower half that ``HOT`` or more documents have, sorted.

    The first shingles of a text in the order are nearly always of the lower half: only these count.
    """

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, list] = {}
        for batch in batches:
            for part, tokens, times in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                more = np.frombuffer(times, np.uint32)
                tokens = np.frombuffer(tokens, np.uint32)
                ones = np.ones(len(tokens) - len(more), np.uint32)
                seen.setdefault(part, []).append((tokens, np.concatenate([ones, more])))
        for part, piles in seen.items():
            tokens, of = np.unique(np.concatenate([t for t, _ in piles]), return_inverse=True)
            sums = np.bincount(of, np.concatenate([n for _, n in piles]))
            hot = sums >= HOT
            keys = (np.int64(part) << 32) | tokens[hot].astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(sums[hot].astype(np.int64), pa.int64())], ["key", "n"]
            )

    counted = read.filter("part IS NOT NULL").select("part", "tokens", "times")
    hot = counted.repartitionById(parts, F.col("part")).mapInArrow(total, "key bigint, n bigint")
    hottest = hot.orderBy(F.desc("n"), "key").limit(MOST_HOT).select("key").toPandas()["key"]
    return np.sort(hottest.to_numpy(np.int64)).astype(np.uint64)


def first_shingles(s: np.ndarray, hot: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The first shingles of a set in the common order, and which of them are hot."""
    wanted = len(s) - (3 * len(s) + 3) // 4 + 1 if len(s) else 0
    low = s[: np.searchsorted(s, HALF)]
    if len(hot):
        keys = _hot_key(low, parts)
        at = np.minimum(np.searchsorted(hot, keys), len(hot) - 1)
        is_hot = hot[at] == keys
    else:
        is_hot = np.zeros(len(low), bool)
    ordered = np.concatenate([low[~is_hot], low[is_hot], s[len(low) :]])[:wanted]
    plain = len(low) - int(is_hot.sum())
    place = np.arange(len(ordered))
    return ordered, (place >= plain) & (place < len(low))


_ENTRY = np.dtype([("token", "<u8"), ("node", "S12")])


def blocks(docs: DataFrame, hot: np.ndarray, parts: int) -> DataFrame:
    """``(block, node)`` of the blocks with several nodes, those with the same nodes once.

    A hot shingle's nodes are dealt over all parts, so they never meet in one task.
    """
    known = docs.sparkSession.sparkContext.broadcast(hot)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def dealt(pile: list[np.ndarray], flags: list[np.ndarray]) -> pa.RecordBatch:
            entries, is_hot = np.concatenate(pile), np.concatenate(flags)
            spread = np.ascontiguousarray(entries["node"]).view("<u4").reshape(-1, 3)[:, 0]
            by_token = ((entries["token"] >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            part = np.where(is_hot, spread.astype(np.uint64) % np.uint64(parts), by_token)
            group = part * np.uint64(2) + is_hot
            order = np.argsort(group, kind="stable")
            group, entries = group[order], entries[order]
            cuts = np.flatnonzero(np.diff(group, prepend=group[:1] + np.uint64(1)))
            ends = [*cuts[1:], len(group)]
            rows = [
                (int(group[a]) // 2, bool(group[a] % np.uint64(2)), entries[a:b].tobytes())
                for a, b in zip(cuts, ends, strict=True)
            ]
            kinds = (pa.int32(), pa.bool_(), pa.binary())
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["part", "hot", "entries"])

        pile, flags, size = [], [], 0
        done: set[bytes] = set()  # copies are dealt once by each task
        for _, sets in _texts(batches):
            for s in filter(len, sets):
                node = set_digest(s)
                if node in done:
                    continue
                done.add(node)
                tokens, is_hot = first_shingles(s, known.value, parts)
                own = np.empty(len(tokens), _ENTRY)
                own["token"], own["node"] = tokens, node
                pile.append(own)
                flags.append(is_hot)
                size += len(own)
            if size >= TOKENS:
                yield dealt(pile, flags)
                pile, flags, size = [], [], 0
        if size:
            yield dealt(pile, flags)

    def nodes_of(entries: np.ndarray) -> list[bytes]:
        raw = entries["node"].tobytes()  # a plain list would drop trailing zero bytes
        return [raw[i : i + 12] for i in range(0, len(raw), 12)]

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(block: np.ndarray, nodes: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(block, pa.int64()), pa.array(nodes, pa.binary())], ["block", "node"]
            )

        plain = []
        for batch in batches:
            for is_hot, raw in zip(batch.column("hot").to_pylist(), batch.column("entries"), strict=True):
                entries = np.frombuffer(raw.as_py(), _ENTRY)
                if is_hot:
                    yield rows(entries["token"].astype(np.int64), nodes_of(entries))
                else:
                    plain.append(entries)
        if not plain:
            return
        entries = np.concatenate(plain)
        entries = entries[np.argsort(entries["token"], kind="stable")]
        token = entries["token"]
        again = token[1:] == token[:-1]
        shared = np.append(again, False) | np.insert(again, 0, False)
        entries = entries[shared]
        if not len(entries):
            return
        cuts = np.flatnonzero(np.diff(entries["token"], prepend=entries["token"][:1] ^ np.uint64(1)))
        met: set[int] = set()
        for a, b in zip(cuts, [*cuts[1:], len(entries)], strict=True):
            nodes = sorted(set(nodes_of(entries[a:b])))
            if len(nodes) > 1:
                block = hash_of(nodes)
                if block not in met:
                    met.add(block)
                    yield rows(np.full(len(nodes), block, np.int64), nodes)

    def hash_of(nodes: list[bytes]) -> int:
        return int.from_bytes(set_digest(np.frombuffer(b"".join(nodes), np.uint8))[:8], "little", signed=True)

    dealt_out = docs.select("text").mapInArrow(deal, "part int, hot boolean, entries binary")
    found = dealt_out.repartitionById(parts, F.col("part")).mapInArrow(gather, "block bigint, node binary")
    return found.distinct()


def node_table(sets: DataFrame) -> DataFrame:
    """Per node its count vector, its size, its smallest doc_id, and one document that has the set."""
    return (
        sets.filter("node IS NOT NULL")
        .groupBy("node")
        .agg(
            F.min("vector").alias("vector"),
            F.min("n_shingles").alias("size"),
            F.min("doc_id").alias("least"),
            F.min(F.struct("doc_id", "mark")).alias("of"),
        )
    )


def _small(side: DataFrame) -> DataFrame:
    """A stored table of short rows, sent to all tasks where it is counted to be within the bounds."""
    width = sum(16 if kind == "binary" else 8 for _, kind in side.dtypes)
    fits = side.count() <= min(BROADCAST_ROWS, BROADCAST_BYTES // width)
    return F.broadcast(side) if fits else side


def _with_sets(docs: DataFrame, nodes: DataFrame, rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with ``shingles``, the set of the node in a column, read from the text of one document.

    ``rows`` holds nodes and whole numbers. Where it is small, no text is shuffled. Of a document that is
    repeated with its id, each task gives the rows once.
    """
    kept = rows.columns
    one = nodes.select(F.col("node").alias(column), "of.doc_id", "of.mark")
    wanted = stored(rows.join(one, column).withColumnsRenamed({"doc_id": "_doc", "mark": "_mark"}), "wanted")
    small = _small(wanted)
    same = docs["doc_id"].eqNullSafe(small["_doc"]) & (F.xxhash64(docs["text"]) == small["_mark"])
    found = docs.select("doc_id", "text").join(small, same).select(*kept, "text")
    at = kept.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for batch, sets in _texts(batches):
            keep, shingles = [], []
            for row, s in zip(zip(*(batch.column(i).to_pylist() for i in range(len(kept))), strict=True), sets, strict=True):
                new = row not in seen and set_digest(s) == row[at]
                keep.append(new)
                if new:
                    seen.add(row)
                    shingles.append(s.tobytes())
            out = batch.select(kept).filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(shingles, pa.binary())], [*kept, "shingles"])

    schema = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    return found.mapInArrow(run, f"{schema}, shingles binary")


def _both_ends(pairs: DataFrame, values: DataFrame, column: str) -> DataFrame:
    a = values.select(F.col("node").alias("u"), F.col(column).alias("a"))
    b = values.select(F.col("node").alias("v"), F.col(column).alias("b"))
    return pairs.join(b, "v").join(a, "u").select("u", "v", "a", "b")


def _fitting(pairs: DataFrame, overlap) -> DataFrame:
    """The pairs for whose values ``overlap`` gives enough; it returns the overlap and both sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("a"), batch.column("b"), strict=True)
            keep = [bool(may_link(*overlap(x.as_py(), y.as_py()))) for x, y in both]
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return pairs.mapInArrow(run, "u binary, v binary")


def _vector_overlap(x: bytes, y: bytes) -> tuple[int, int, int]:
    x, y = unpacked(x), unpacked(y)
    return overlap_bound(x, y), x.sum(), y.sum()


def _set_overlap(x: bytes, y: bytes) -> tuple[int, int, int]:
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    return len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)


def linked(docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs ``(u, v)`` of nodes whose sets link; ``v`` are hubs, few beside the nodes ``u``."""
    pairs = stored(pairs, "pairs")
    hubs = stored(_with_sets(docs, nodes, pairs.select("v").distinct(), "v"), "hub-sets")
    own = _with_sets(docs, nodes, pairs, "u").withColumnRenamed("shingles", "a")
    both = own.join(hubs.withColumnRenamed("shingles", "b"), "v").select("u", "v", "a", "b")
    found = stored(_fitting(both, _set_overlap).distinct(), "links")
    forget(pairs, hubs)
    return found


def _hub_pairs(members: DataFrame, turn: int) -> tuple[DataFrame, list[DataFrame]]:
    """Each node with the hub that most of its blocks have, if that is of another component.

    Also the stored tables that the pairs read. A block's hub is first its node with the most blocks, as the text the copies were made from; in
    later turns any other.
    """
    chance = F.xxhash64("node", F.lit(turn))
    read = []
    if turn:
        ranked = members.withColumn("rank", F.struct(F.lit(0).cast("long").alias("n"), chance.alias("c")))
    else:
        degrees = stored(members.groupBy("node").agg(F.count(F.lit(1)).alias("n")), "degrees")
        read.append(degrees)
        ranked = members.drop("n").join(degrees, "node")
        ranked = ranked.withColumn("rank", F.struct("n", chance.alias("c")))
    both = F.max_by(F.struct("node", "component"), "rank")
    hubs = ranked.groupBy("block").agg(both.alias("h"))
    hubs = hubs.select("block", F.col("h.node").alias("hub"), F.col("h.component").alias("hub_component"))
    hubs = stored(hubs, "hubs")
    read.append(hubs)
    met = members.join(hubs, "block").filter("component != hub_component")
    times = met.groupBy("node", "hub").agg(F.count(F.lit(1)).alias("n"))
    chosen = times.groupBy("node").agg(F.max_by("hub", F.struct("n", "hub")).alias("hub"))
    return chosen.select(F.col("node").alias("u"), F.col("hub").alias("v")), read


def _left(members: DataFrame, groups: DataFrame) -> DataFrame:
    """Members, with their component and the block's nodes ``n``, of blocks that several components meet in."""
    labelled = members.join(groups, "node", "left").select(
        "block", "node", F.coalesce("component", "node").alias("component")
    )
    labelled = stored(labelled, "labelled")
    met = labelled.groupBy("block").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("n")
    )
    met = stored(met.filter("low != high").select("block", "n"), "met")
    left = stored(labelled.join(met, "block"), "left")
    forget(labelled, met)
    return left


class Forest:
    """Which of some nodes hang together so far."""

    def __init__(self):
        self.parent: dict[bytes, bytes] = {}

    def root(self, node: bytes) -> bytes:
        parent = self.parent
        while (above := parent.get(node, node)) != node:
            parent[node] = node = parent.get(above, above)
        return node

    def joins(self, u: bytes, v: bytes) -> bool:
        """Whether the two were apart; now they are not."""
        u, v = self.root(u), self.root(v)
        self.parent[u] = v
        return u != v


def _spots(chunks: Column) -> Column:
    """A node's chunk ``own``, and all pairs ``i <= j`` of chunks that it takes part in."""
    own = F.pmod(F.hash("node"), chunks)
    pair = lambda i: F.struct(F.least(own, i).alias("i"), F.greatest(own, i).alias("j"), own.alias("own"))
    return F.explode(F.transform(F.sequence(F.lit(0), chunks - 1), pair))


def _of_size(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Members of small blocks that another one's size allows to link; large blocks are kept as they are."""
    sized = members.join(nodes.select("node", "size"), "node")
    by_size = Window.partitionBy("block").orderBy("size")
    near = (4 * F.lag("size").over(by_size) >= 3 * F.col("size")) | (3 * F.lead("size").over(by_size) <= 4 * F.col("size"))
    small = sized.filter(F.col("n") <= CHUNK).withColumn("near", near).filter("near").drop("near")
    return small.unionByName(sized.filter(F.col("n") > CHUNK))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows that follow each other and have the same first three columns, one of each node, the fourth.

    A node of a repeated document may come from several tasks.
    """
    flat = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    for _, group in groupby(flat, key=lambda r: r[:3]):
        one: dict[bytes, tuple] = {}
        for row in group:
            one.setdefault(row[3], row)
        yield list(one.values())


def _edges(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    columns = zip(*pairs, strict=True) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], ["u", "v"])


def _tree_forest(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs of different components that can link, by an R-tree per block or pair of chunks: a spanning forest."""
    spots = _spots(F.ceil(F.col("n") / CHUNK).cast("int"))
    rows = (
        _of_size(members, nodes)
        .withColumn("spot", spots)
        .select("block", "node", "component", "spot.*")
        .join(nodes.select("node", "vector"), "node")
        .repartition("block", "i", "j")
        .sortWithinPartitions("block", "i", "j")
    )

    def forest(group: list[tuple]) -> Iterator[tuple[bytes, bytes]]:
        """Nodes of the first chunk are searched for those of the second, or of their own."""
        _, i, j = group[0][:3]
        vectors = [unpacked(g[6]) for g in group]
        groups = min(map(len, vectors))
        left = [k for k, g in enumerate(group) if g[5] == i]
        right = left if i == j else [k for k, g in enumerate(group) if g[5] == j]
        if not left or not right:
            return
        tree = RTree(np.array([folded(vectors[k], groups) for k in left]))
        met = Forest()
        for k in right:
            node, component = group[k][3:5]
            size = int(vectors[k].sum())
            for row in tree.search(folded(vectors[k], groups)):
                other = left[row]
                if group[other][4] == component or met.root(group[other][3]) == met.root(node):
                    continue
                if may_link(overlap_bound(vectors[k], vectors[other]), size, int(vectors[other].sum())):
                    met.joins(node, group[other][3])
                    yield node, group[other][3]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            yield _edges(list(forest(group)))

    ordered = rows.select("block", "i", "j", "node", "component", "own", "vector")
    return ordered.mapInArrow(run, "u binary, v binary").distinct()


def _links_of(group: list[tuple]) -> Iterator[tuple[bytes, bytes]]:
    """A spanning forest of the links between components in two chunks of a cluster, or within one.

    Overlaps are counted exactly: the shingles of the first chunk are sorted with the number of their
    node, and those of a node of the second look up which nodes have them.
    """
    _, i, j = group[0][:3]
    left = [g for g in group if g[5] == i]
    right = left if i == j else [g for g in group if g[5] == j]
    if not left or not right:
        return
    sets = [np.frombuffer(g[6], np.uint64) for g in left]
    sizes = np.array(list(map(len, sets)))
    tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    met = Forest()
    for g in group:
        met.joins(g[3], g[4])
    for _, _, _, node, _, _, raw in right:
        own = np.frombuffer(raw, np.uint64)
        first, last = np.searchsorted(tokens, own, "left"), np.searchsorted(tokens, own, "right")
        times = last - first
        at = np.repeat(first - np.cumsum(times) + times, times) + np.arange(times.sum())
        overlap = np.bincount(owner[at], minlength=len(left))
        for k in np.flatnonzero(may_link(overlap, sizes, len(own))):
            if met.joins(node, left[k][3]):
                yield node, left[k][3]


def _cluster_links(docs: DataFrame, nodes: DataFrame, members: DataFrame, forest: DataFrame) -> DataFrame:
    """The links between different components: a spanning forest of those of each cluster, or pair of its chunks."""
    clusters = stored(components(forest).withColumnRenamed("component", "cluster"), "clusters")
    sizes = clusters.join(nodes.select("node", "size"), "node").groupBy("cluster")
    totals = stored(sizes.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("shingles")), "cluster-sizes")
    chunks = F.ceil(F.greatest(F.col("n") / CHUNK, F.col("shingles") / CHUNK_SHINGLES)).cast("int")
    labels = members.select("node", "component").distinct()
    rows = (
        clusters.join(labels, "node")
        .join(totals, "cluster")
        .withColumn("spot", _spots(chunks))
        .select("cluster", "spot.*", "node", "component")
    )
    rows = stored(rows, "cluster-nodes")
    sets = _with_sets(docs, nodes, rows, "node")
    dealt = sets.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            yield _edges(list(_links_of(group)))

    ordered = dealt.select("cluster", "i", "j", "node", "component", "own", "shingles")
    links = stored(ordered.mapInArrow(run, "u binary, v binary").distinct(), "links")
    forget(clusters, totals, rows)
    return links


def node_components(docs: DataFrame, nodes: DataFrame, hot: np.ndarray, parts: int) -> DataFrame:
    """``(node, component)`` of the nodes that link with another one. ``nodes`` is a stored node table."""
    spark = docs.sparkSession
    members = stored(blocks(docs, hot, parts), "blocks")
    links = spark.createDataFrame([], "u binary, v binary")
    groups = spark.createDataFrame([], "node binary, component binary")
    left = _left(members, groups)
    for turn in range(STARS):
        large = left.filter(F.col("n") > LARGE)
        compared = large.select("node").distinct().count()
        if not compared:
            break
        hubs, read = _hub_pairs(large, turn)
        new = linked(docs, nodes, _fitting(_both_ends(hubs, nodes, "vector"), _vector_overlap))
        forget(*read, left)
        links = links.union(new)
        groups = stored(components(links), "groups")
        left = _left(members, groups)
        forget(groups)
        if new.count() <= FEW_LINKS * compared:
            break
    forest = stored(_tree_forest(left, nodes), "forest")
    links = links.union(_cluster_links(docs, nodes, left, forest))
    groups = stored(components(links), "groups")
    forget(members, left, forest)
    return groups


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row of ``docs`` (doc_id, text).

    ``mark`` (a hash of the text) and ``component`` (a node, null without shingles) come with it.
    """
    docs = docs.select("doc_id", "text")
    parts = _parts(docs)
    read = stored(read_texts(docs, parts), "read-texts")
    hot = hot_shingles(read, parts)
    documents = read.filter("part IS NULL")
    nodes = stored(node_table(documents), "nodes")
    sets = stored(documents.select("doc_id", "mark", "n_shingles", "node"), "doc-sets")
    forget(read)
    groups = node_components(docs, nodes, hot, parts)
    rooted = nodes.select("node", "least").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    rooted = stored(rooted, "rooted")
    ids = stored(rooted.groupBy("component").agg(F.min("least").alias("component_id")), "ids")
    by_node = stored(rooted.join(ids, "component").select("node", "component", "component_id"), "node-ids")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return sets.join(by_node, "node", "left").select(
        "doc_id", "n_shingles", own.alias("component_id"), "mark", "component"
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest id.

    Documents without shingles stay; rows with the same doc_id and text count as one.
    """
    found = near_duplicates(docs)
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "mark")
    picked = found.filter("component IS NOT NULL").groupBy("component").agg(F.min(rank).alias("of")).select("of.*")
    alone = found.filter("component IS NULL").select("doc_id", "mark")
    kept = stored(picked.select("doc_id", "mark").union(alone).distinct(), "kept")
    mark = F.xxhash64(docs["text"])
    same = docs["doc_id"].eqNullSafe(kept["doc_id"]) & (mark == kept["mark"])
    rows = docs.withColumn("_mark", mark).join(kept, same, "left_semi")
    return rows.dropDuplicates(["doc_id", "_mark"]).drop("_mark")
