"""Web archives (WARC) with a two-level capture index.

Writing. ``write_archives`` takes one row per capture and writes each as a gzip member of its own into
archive files in a shared folder; the rows it returns say where each record lies. Payloads equal to
another one's become revisit records, which name the capture that holds the payload.

Indexing. ``build_index`` sorts the captures by key, the URL with its host reversed
(``com,example,www)/path``), and then by id. Lines of sorted captures are packed into compressed blocks;
for each range of keys one file has the blocks and another one the directory, with the first key of each
block and where it lies. The index holds a line per capture, the directory a line per ``BLOCK_LINES`` of
them, and what is sent to every task only the key bounds of the ranges, one per ``RANGE_LINES``.

Reading. ``look_up`` finds captures by URL, or by URL and id: a binary search over the bounds gives the
ranges, one over a range's directory the block, and one over the block's lines the captures. Look-ups are
sorted first, so a block is read once for many of them. ``read_records`` then reads the records where
they lie, sorted by file and place, neighbours at once.

Files are written and read by the tasks through the file system that the folder's address names (local or
shared path, HDFS, S3, GCS). A file's name holds a random part, and only files named in a stored table
are ever read: what a lost or repeated task leaves behind is not seen.

Defined results: a null payload is empty. A null URL, or one without ``://``, has its text or nothing as
its key. A null id orders before all others and is written as nothing. Of equal payloads of at least
``REVISIT_BYTES`` the rows with the largest id hold the payload (all rows with that id, should it be
repeated, and all if every id is null); the others revisit it. Repeated rows are captures of their own; a
look-up of their URL and id finds each once. Empty tables give archives and an index without files.
Payloads of any size are written whole; a record is the unit that has to fit a task. Columns other than
id, URL and payload are not used, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.common import shuffle_partitions, stored
from starmart.operators.lookup import sized
from starmart.session import scratch_path
from starmart.sources import paths

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 1 << 30  # an archive file is closed beyond it
BLOCK_LINES = 2000
RANGE_LINES = 500_000
READ_BYTES = 4 << 20  # neighbouring records read at once, up to
READ_RANGE = 64 << 20  # records of a file dealt to one task

# The profile and protocol names of the WARC 1.1 format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESPONSE_TYPE = "application/http; msgtype=response"
NO_DATE = "1970-01-01T00:00:00Z"

PLACE = "file string, at bigint, length bigint"
CAPTURE = f"key string, id bigint, record_type string, digest string, {PLACE}"
RECORD = (
    "id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, digest string, payload binary"
)


def _files(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system that an address names, and the path there."""
    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", folder))


def url_key(url: str | None) -> str:
    """Sort key of a URL: reversed host, ``)``, path and query; spaces and controls are escaped."""
    text = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url or "")
    scheme, found, rest = text.partition("://")
    if not found:
        return text
    host, path = re.match(r"([^/?#]*)(.*)", rest, re.DOTALL).groups()
    host = re.sub(r":(80|443)?$", "", host.rpartition("@")[2].lower())
    return f"{','.join(reversed(host.split('.')))}){path.partition('#')[0] or '/'}"


def _order(id_: int | None) -> tuple[bool, int]:
    return (id_ is not None, id_ or 0)


# Writing


def typed(pages: DataFrame, page_id: str, url: str, payload: str) -> DataFrame:
    """``(id, url, payload, digest, refers_to)``; ``refers_to`` is null for what is stored whole.

    Only digests that occur more than once are joined. The join sends them to all tasks where they
    are measured to be few, else it shuffles both sides, and Spark splits hot digests.
    """
    whole = pages.select(
        F.col(page_id).cast("bigint").alias("id"),
        F.col(url).alias("url"),
        F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    large = whole.select("id", "digest", F.octet_length("payload").alias("size")).filter(F.col("size") >= REVISIT_BYTES)
    groups = large.groupBy("digest").agg(F.max("id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    repeated = stored(groups.filter("n > 1").select("digest", "refers_to"), "repeated-payloads")
    told = whole.join(sized(repeated), "digest", "left")
    return told.select(
        "id", "url", "payload", "digest", F.when(~F.equal_null("id", "refers_to"), F.col("refers_to")).alias("refers_to")
    )


def record(id_: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record. A revisit keeps the HTTP headers, so the payload's length, but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    target = re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m.group()):02X}", url or "")
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<urn:capture:{'' if id_ is None else id_}>",
        "WARC-Date": NO_DATE,
        "WARC-Target-URI": target,
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
        "Content-Type": RESPONSE_TYPE,
        "Content-Length": len(block),
    }
    if refers_to is not None:
        fields |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": f"<urn:capture:{refers_to}>"}
    head = "\r\n".join([VERSION, *(f"{name}: {value}" for name, value in fields.items())])
    return head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def packed(data: bytes) -> bytes:
    """One gzip member."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


def unpacked(data: bytes) -> bytes:
    return zlib.decompress(data, 31)


class _Output:
    """A new file of a random name, filled from its start."""

    def __init__(self, folder: str, name: str):
        self.name = f"{uuid.uuid4().hex}-{name}"
        files, root = _files(folder)
        files.create_dir(root, recursive=True)
        self.stream = files.open_output_stream(f"{root}/{self.name}", compression=None)
        self.at = 0

    def add(self, data: bytes) -> tuple[int, int]:
        """Where the data lies: its start and length."""
        self.stream.write(data)
        self.at += len(data)
        return self.at - len(data), len(data)


def write_archives(captures: DataFrame, folder: str) -> DataFrame:
    """Writes ``(id, url, payload, digest, refers_to)`` rows; returns a stored table with one row per record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            rows = []
            for values in zip(*batch.columns, strict=True):
                id_, url, payload, digest, refers_to = (v.as_py() for v in values)
                out = out or _Output(folder, "archive.warc.gz")
                at, length = out.add(packed(record(id_, url, payload, digest, refers_to)))
                kind = "response" if refers_to is None else "revisit"
                rows.append((url_key(url), id_, kind, digest, out.name, at, length))
                if out.at > ARCHIVE_BYTES:
                    out.stream.close()
                    out = None
            yield _batch(rows, CAPTURE)
        if out:
            out.stream.close()

    columns = ("id", "url", "payload", "digest", "refers_to")
    return stored(captures.select(*columns).mapInArrow(run, CAPTURE), "captures")


_ARROW = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [part.split() for part in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [()] * len(fields)
    arrays = [pa.array(c, _ARROW[kind]) for c, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


# Indexing


@dataclass(frozen=True)
class Range:
    """A run of sorted captures: its first and last place in the order, and its two files."""

    first: tuple
    last: tuple
    blocks: str
    directory: str


@dataclass(frozen=True)
class Index:
    """A capture index in a folder; ``ranges`` in order, one per ``RANGE_LINES`` captures or so."""

    spark: SparkSession
    folder: str
    ranges: list[Range]
    captures: int


RANGE = "first_key string, first_id bigint, last_key string, last_id bigint, blocks string, directory string"


def build_index(captures: DataFrame, folder: str) -> Index:
    """Sorts the captures' keys into compressed blocks and a directory per range of keys."""
    spark = captures.sparkSession
    total = captures.count()
    tasks = max(1, min(shuffle_partitions(spark), total // BLOCK_LINES), -(-total // RANGE_LINES))
    order = ["key", F.asc_nulls_first("id"), "file", "at"]
    lines = captures.repartitionByRange(tasks, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, directory, pending = None, [], []
        first = last = None

        def close_block() -> None:
            at, length = blocks.add(packed("\n".join(map(json.dumps, pending)).encode()))
            directory.append([pending[0][0], pending[0][1], at, length])
            pending.clear()

        for batch in batches:
            for values in zip(*batch.columns, strict=True):
                line = [v.as_py() for v in values]
                blocks = blocks or _Output(folder, "blocks.gz")
                first, last = first or line[:2], line[:2]
                pending.append(line)
                if len(pending) == BLOCK_LINES:
                    close_block()
        if blocks:
            if pending:
                close_block()
            blocks.stream.close()
            entries = _Output(folder, "directory.gz")
            entries.add(packed("\n".join(map(json.dumps, directory)).encode()))
            entries.stream.close()
            yield _batch([(*first, *last, blocks.name, entries.name)], RANGE)

    written = stored(lines.select(*_names(CAPTURE)).mapInArrow(run, RANGE), "index-ranges")
    rows = written.collect()  # one per range
    bounds = [
        Range((r.first_key, _order(r.first_id)), (r.last_key, _order(r.last_id)), r.blocks, r.directory) for r in rows
    ]
    return Index(spark, folder, sorted(bounds, key=lambda r: (r.first, r.last)), total)


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


# Reading


class _Opened:
    """The file last read, and the part of it last unpacked."""

    def __init__(self, folder: str):
        self.files, self.root = _files(folder)
        self.name, self.stream = None, None

    def read(self, name: str, at: int, length: int) -> bytes:
        if name != self.name:
            self.close()
            self.name, self.stream = name, self.files.open_input_file(f"{self.root}/{name}")
        self.stream.seek(at)
        return self.stream.read(length)

    def lines(self, name: str, at: int, length: int | None) -> list[list]:
        return [json.loads(line) for line in unpacked(self.read(name, at, length)).decode().split("\n")]

    def close(self) -> None:
        if self.stream:
            self.stream.close()


class _RangeReader:
    """Look-ups in one range: its directory in memory, and the block last read."""

    def __init__(self, opened: _Opened, bounds: Range):
        self.opened, self.bounds = opened, bounds
        self.directory = opened.lines(bounds.directory, 0, None)
        self.firsts = [(key, _order(id_)) for key, id_, _, _ in self.directory]
        self.number, self.block, self.places = -1, [], []

    def _read(self, number: int) -> None:
        if number != self.number:
            _, _, at, length = self.directory[number]
            self.number, self.block = number, self.opened.lines(self.bounds.blocks, at, length)
            self.places = [(line[0], _order(line[1])) for line in self.block]

    def find(self, low: tuple, high: tuple) -> Iterator[list]:
        """The lines whose place is between the two, in order."""
        number = max(0, bisect_left(self.firsts, low) - 1)
        while number < len(self.firsts) and self.firsts[number] <= high:
            self._read(number)
            yield from self.block[bisect_left(self.places, low) : bisect_right(self.places, high)]
            number += 1


_LAST_ID = (True, 1 << 63)
_FIRST_ID = (False, 0)


def _span(key: str, id_: int | None, by_id: bool) -> tuple[tuple, tuple]:
    """From where to where the captures of a key, or of a key and id, lie in the order."""
    return ((key, _order(id_)),) * 2 if by_id else ((key, _FIRST_ID), (key, _LAST_ID))


WANTED = "part int, key string, id bigint"


def look_up(index: Index, wanted: DataFrame, url: str = "url", capture_id: str | None = None) -> DataFrame:
    """The captures of the wanted URLs, or of pairs of URL and id; each once, however often it is wanted."""
    spark, by_id = index.spark, capture_id is not None
    ranges = spark.sparkContext.broadcast(index.ranges)
    folder = index.folder

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, lasts = [r.first for r in ranges.value], [r.last for r in ranges.value]
        for batch in batches:
            rows = []
            for address, id_ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                key = url_key(address)
                low, high = _span(key, id_, by_id)
                rows += [(part, key, id_) for part in range(bisect_left(lasts, low), bisect_right(firsts, high))]
            yield _batch(rows, WANTED)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, part, reader = _Opened(folder), None, None
        for batch in batches:
            rows = []
            for number, key, id_ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if number != part:
                    part, reader = number, _RangeReader(opened, ranges.value[number])
                for line in reader.find(*_span(key, id_, by_id)):
                    rows.append(tuple(line))
                    if len(rows) == BLOCK_LINES:
                        yield _batch(rows, CAPTURE)
                        rows = []
            yield _batch(rows, CAPTURE)
        opened.close()

    id_column = F.col(capture_id).cast("bigint") if by_id else F.lit(None).cast("bigint")
    queries = wanted.select(F.col(url).alias("url"), id_column.alias("id")).distinct()
    placed = queries.mapInArrow(place, WANTED).distinct()
    sorted_ = placed.repartitionByRange(shuffle_partitions(spark), "part", "key", "id")
    return sorted_.sortWithinPartitions("part", "key", "id").mapInArrow(find, CAPTURE)


def parsed(raw: bytes) -> tuple:
    """A record as a row: a response's digest and length are those of the payload read."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"Content-Length: ([0-9]+)", http).group(1))
    stated = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    number = lambda name: int(n) if (n := fields.get(name, "")[len("<urn:capture:") : -1]) else None
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload), hashlib.sha1(payload).hexdigest()) != (length, stated):
        raise ValueError(f"the payload of record {fields['WARC-Record-ID']} is not what its header states")
    return (
        number("WARC-Record-ID"),
        fields["WARC-Target-URI"],
        kind,
        number("WARC-Refers-To"),
        length,
        stated,
        payload if kind == "response" else None,
    )


def read_records(captures: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records at the captures' places; a revisit has no payload of its own.

    Places are dealt by file and ``READ_RANGE`` and read in order, neighbours at once.
    """
    spark = captures.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = _Opened(folder)

        def records(run_: list[tuple]) -> list[tuple]:
            name, start, _ = run_[0]
            data = opened.read(name, start, run_[-1][1] + run_[-1][2] - start)
            rows = [parsed(unpacked(data[at - start : at - start + length])) for _, at, length in run_]
            return rows if payloads else [(*row[:-1], None) for row in rows]

        for batch in batches:
            waiting: list[tuple] = []
            for name, at, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                follows = waiting and waiting[-1][0] == name and waiting[-1][1] + waiting[-1][2] == at
                if waiting and not (follows and at + length - waiting[0][1] <= READ_BYTES):
                    yield _batch(records(waiting), RECORD)
                    waiting = []
                waiting.append((name, at, length))
            if waiting:
                yield _batch(records(waiting), RECORD)
        opened.close()

    places = captures.select(*_names(PLACE)).withColumn("deal", F.floor(F.col("at") / READ_RANGE))
    dealt = places.repartition(shuffle_partitions(spark), "file", "deal").sortWithinPartitions("file", "at")
    return dealt.drop("deal").mapInArrow(run, RECORD)


def archived(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html") -> tuple[Index, str]:
    """Archives and index of all pages in new shared folders; returns the index and the archives' folder."""
    spark = pages.sparkSession
    archives, index = scratch_path(spark, "archives"), scratch_path(spark, "capture-index")
    for folder in (archives, index):
        paths.make_folder(spark, folder)
    captures = write_archives(typed(pages, page_id, url, payload), archives)
    return build_index(captures, index), archives
