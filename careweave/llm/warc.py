"""WARC archives with a two-level capture index: blocks of sorted keys under a sparse directory."""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from careweave.session import materialize, shared_dir, task_slots

KEY_CHARACTERS = 1000
BLOCK_LINES = 3000
ARCHIVE_BYTES = 1 << 30
READ_BYTES = 4 << 20
TRAILER = ">QQ"
#: Names of the format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# --- keys ------------------------------------------------------------------------

def _plain(text: str) -> str:
    """White space and control characters as percent codes, so that a key is one word."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def url_key(url: str | None) -> str:
    """``com,example,www)/path?query``: host reversed and lower-cased, then path and query.

    Scheme, user and fragment are left out; numeric hosts stay as they are; a text without
    ``://`` is its own key behind ``)``, null is ``-``. Keys over 1,000 characters end in a digest.
    """
    if url is None:
        return "-"
    _, found, rest = url.partition("://")
    if found:
        rest = rest.partition("#")[0]
        at = min((rest.find(c) for c in "/?" if c in rest), default=len(rest))
        host, _, port = rest[:at].rpartition("@")[2].lower().partition(":")
        if not host.replace(".", "").isdigit():
            host = ",".join(reversed(host.split(".")))
        key = f"{host}{':' + port if port else ''}){rest[at:]}"
    else:
        key = ")" + url
    key = _plain(key)
    if len(key) > KEY_CHARACTERS:
        key = f"{key[:KEY_CHARACTERS]}~{hashlib.sha1(key.encode()).hexdigest()}"
    return key


def capture_key(url: str | None, page_id: int | None) -> str:
    """The key of one capture: the key of its URL, then the id as digits that sort as it does."""
    return f"{url_key(url)} {'-' if page_id is None else format(page_id + 2**63, '016x')}"


def captures_of(url: str | None) -> tuple[str, str]:
    """The key range of all captures of a URL."""
    key = url_key(url)
    return f"{key} ", f"{key}!"


def captures_under(host: str) -> list[tuple[str, str]]:
    """The key ranges of a host, its ports and the hosts below it."""
    key = ",".join(reversed(host.lower().split(".")))
    return [(f"{key})", f"{key}*"), (f"{key}:", f"{key};"), (f"{key},", f"{key}-")]


# --- records ---------------------------------------------------------------------

def _block(names: Iterable[tuple[str, object]]) -> str:
    return "".join(f"{name}: {value}\r\n" for name, value in names if value is not None)


def record_id(page_id: int | None, url: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url}')}>"


def make_record(page_id: int | None, url: str | None, sha1_hex: str, n_bytes: int, payload: bytes | None,
                refers: tuple[int | None, str | None] | None, date: str) -> bytes:
    """A response with its payload, or a revisit of another page's response without."""
    http = ("HTTP/1.1 200 OK\r\n" + _block([("Content-Type", "text/html; charset=utf-8"),
                                            ("Content-Length", n_bytes)]) + "\r\n").encode()
    block = http if refers else http + payload
    named = [("WARC-Type", "revisit" if refers else "response"), ("WARC-Record-ID", record_id(page_id, url)),
             ("WARC-Date", date), ("WARC-Target-URI", None if url is None else _plain(url)),
             ("WARC-Page-ID", page_id),
             ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(sha1_hex)).decode())]
    if refers:
        named += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(*refers)),
                  ("WARC-Refers-To-Target-URI", None if refers[1] is None else _plain(refers[1])),
                  ("WARC-Refers-To-Page-ID", refers[0])]
    named += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    return ("WARC/1.1\r\n" + _block(named) + "\r\n").encode() + block + b"\r\n\r\n"


def _names(block: bytes) -> dict[str, str]:
    return dict(x.split(": ", 1) for x in block.decode().split("\r\n")[1:])


def read_record(record: bytes) -> dict:
    """What a record says; the payload of a response is held against its digest and length."""
    head, _, rest = record.partition(b"\r\n\r\n")
    named = _names(head)
    block = rest[:int(named["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, n_bytes = named["WARC-Type"], int(_names(http)["Content-Length"])
    digest = named["WARC-Payload-Digest"].partition(":")[2]
    if kind == "response" and (len(payload) != n_bytes or base64.b32encode(
            hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"damaged record {named['WARC-Record-ID']}")

    def number(name):
        return int(named[name]) if name in named else None

    return {"page_id": number("WARC-Page-ID"), "url": named.get("WARC-Target-URI"), "record_type": kind,
            "payload_bytes": n_bytes, "payload_digest": digest,
            "refers_to": number("WARC-Refers-To-Page-ID"), "payload": payload if kind == "response" else None}


# --- files -----------------------------------------------------------------------

class _Folder:
    """A shared folder by path or URI; every file that a task begins has a name of its own, and
    only those that a finished task names are ever read."""

    def __init__(self, uri: str):
        self.fs, self.path = fs.FileSystem.from_uri(uri)
        self.name, self.file = None, None

    def create(self, kind: str):
        self.fs.create_dir(self.path, recursive=True)
        name = f"{kind}-{uuid.uuid4().hex}"
        return name, self.fs.open_output_stream(f"{self.path}/{name}")

    def read(self, name: str, offset: int, length: int) -> bytes:
        return self._open(name).read_at(length, offset)

    def size(self, name: str) -> int:
        return self._open(name).size()

    def _open(self, name: str):
        if name != self.name:
            if self.file is not None:
                self.file.close()
            self.name, self.file = name, self.fs.open_input_file(f"{self.path}/{name}")
        return self.file


@dataclass
class CaptureIndex:
    """``folder`` has archives and index files; ``shards`` a row per index file: file, first (the
    smallest key), blocks, captures; ``captures`` a row per record as it was written."""

    folder: str
    shards: DataFrame
    captures: DataFrame


def _write_archives(rows: DataFrame, folder: str, date: str, level: int, archive_bytes: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, name, file, at = _Folder(folder), None, None, 0
        for batch in batches:
            out = [[], [], [], []]
            for r in batch.to_pylist():
                if file is None:
                    name, file = store.create("archive")
                    at = 0
                refers = (r["first"]["page_id"], r["first"]["url"]) if r["revisit"] else None
                packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                member = packer.compress(make_record(
                    r["page_id"], r["url"], r["sha1"], r["n_bytes"], r["payload"], refers, date)) + packer.flush()
                file.write(member)
                for column, x in zip(out, (capture_key(r["url"], r["page_id"]), name, at, len(member)), strict=True):
                    column.append(x)
                at += len(member)
                if at >= archive_bytes:
                    file.close()
                    file = None
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.string()), pa.array(out[1], pa.string()),
                 *(pa.array(x, pa.int64()) for x in out[2:])], names=["key", "file", "offset", "length"])
        if file is not None:
            file.close()

    return materialize(rows.mapInArrow(run, "key string, file string, offset long, length long"))


def _write_index(captures: DataFrame, folder: str, block_lines: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, name, file, at = _Folder(folder), None, None, 0
        lines, directory, n = [], [], 0

        def close_block():
            nonlocal at
            packed = zlib.compress("\n".join(lines).encode())
            directory.append([lines[0].rsplit(" ", 3)[0], at, len(packed)])
            file.write(packed)
            at += len(packed)
            lines.clear()

        for batch in batches:
            for key, archive, offset, length in zip(*(batch.column(c).to_pylist() for c in (
                    "key", "file", "offset", "length")), strict=True):
                if file is None:
                    name, file = store.create("index")
                lines.append(f"{key} {archive} {offset} {length}")
                n += 1
                if len(lines) == block_lines:
                    close_block()
        if file is not None:
            if lines:
                close_block()
            packed = zlib.compress(json.dumps(directory).encode())
            file.write(packed + struct.pack(TRAILER, at, len(packed)))
            file.close()
            yield pa.RecordBatch.from_pylist([{"file": name, "first": directory[0][0],
                                               "blocks": len(directory), "captures": n}])

    ordered = captures.repartitionByRange("key", "file", "offset").sortWithinPartitions("key", "file", "offset")
    return materialize(ordered.mapInArrow(run, "file string, first string, blocks long, captures long"))


def write(pages: DataFrame, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", level: int = 4,
          block_lines: int = BLOCK_LINES, archive_bytes: int = ARCHIVE_BYTES,
          folder: str | None = None) -> CaptureIndex:
    """One record per row in gzip members, and the index of all captures.

    Of equal payloads (by SHA-256 and length) of at least ``min_bytes`` bytes the row with the
    smallest page_id is a response and the others revisit it; null ids come last, equal ids go
    by URL, and rows that share id, URL and payload with the response are responses too.
    Smaller payloads are all responses. Null html is empty, a null URL has no target, a null id
    no id; control characters in URLs are percent-encoded. Other columns are ignored; an empty
    table gives an empty index. Archives are written where their rows are; only keys are sorted.
    """
    spark = pages.sparkSession
    folder = folder or f"{shared_dir(spark)}/warc/{uuid.uuid4().hex}"
    body = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", body.alias("payload")).select(
        "*", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").cast("long").alias("n_bytes"))
    first = F.min(F.struct(F.col("page_id").isNull().alias("last"), "page_id", "url"))
    # A stored table, so the planner knows its size: payloads only move where it is large, and
    # then adaptive execution splits the partitions of hot digests.
    shared = materialize(rows.where(F.col("n_bytes") >= min_bytes).groupBy("digest", "n_bytes").agg(
        first.alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    rows = rows.join(shared, ["digest", "n_bytes"], "left").withColumn(
        "revisit", F.col("first").isNotNull() & ~(
            F.col("page_id").eqNullSafe(F.col("first.page_id")) & F.col("url").eqNullSafe(F.col("first.url"))))
    rows = rows.select("page_id", "url", F.sha1("payload").alias("sha1"), "n_bytes", "first", "revisit",
                       F.when(~F.col("revisit"), F.col("payload")).alias("payload"))
    captures = _write_archives(rows, folder, date, level, archive_bytes)
    return CaptureIndex(folder, _write_index(captures, folder, block_lines), captures)


# --- lookup ----------------------------------------------------------------------

class _Shard:
    """An index file: its sparse directory, and the block that was read last."""

    def __init__(self, store: _Folder, name: str):
        self.store, self.name, size = store, name, store.size(name)
        n = struct.calcsize(TRAILER)
        offset, length = struct.unpack(TRAILER, store.read(name, size - n, n))
        self.directory = json.loads(zlib.decompress(store.read(name, offset, length)))
        self.firsts = [x[0] for x in self.directory]
        self.at, self.keys, self.lines = None, [], []

    def load(self, at: int) -> None:
        if at != self.at:
            _, offset, length = self.directory[at]
            text = zlib.decompress(self.store.read(self.name, offset, length)).decode()
            self.at, self.lines = at, [line.rsplit(" ", 3) for line in text.split("\n")]
            self.keys = [x[0] for x in self.lines]

    def find(self, low: str, high: str) -> Iterator[list[str]]:
        """Captures with low <= key < high: binary search in the directory, then in the blocks."""
        at = max(0, bisect_left(self.firsts, low) - 1)
        while at < len(self.firsts) and self.firsts[at] < high:
            self.load(at)
            a, b = bisect_left(self.keys, low), bisect_left(self.keys, high)
            yield from self.lines[a:b]
            if b < len(self.keys):
                break
            at += 1


def lookup(index: CaptureIndex, ranges: DataFrame) -> DataFrame:
    """key, file, offset, length of the captures in every row's key range [low, high).

    One row per index file goes to the tasks, keys are bounded; ranges are cut at the index files
    and dealt out by key, so tasks read neighbouring blocks, each once. A capture that lies in
    several ranges comes once for each; null bounds find nothing.
    """
    shards = sorted((r["first"], r["file"]) for r in index.shards.select("first", "file").collect())
    firsts, files, folder = [x[0] for x in shards], [x[1] for x in shards], index.folder

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[], [], []]
            for low, high in zip(*(batch.column(c).to_pylist() for c in ("low", "high")), strict=True):
                if low is None or high is None or not files:
                    continue
                # Equal keys may go on from one file to the next.
                for shard in range(max(0, bisect_left(firsts, low) - 1), bisect_left(firsts, high)):
                    for column, x in zip(out, (shard, low, high), strict=True):
                        column.append(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int32()), *(pa.array(x, pa.string()) for x in out[1:])],
                names=["shard", "low", "high"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, number, shard = _Folder(folder), None, None
        for batch in batches:
            found = []
            for at, low, high in zip(*(batch.column(c).to_pylist() for c in ("shard", "low", "high")), strict=True):
                if at != number:
                    number, shard = at, _Shard(store, files[at])
                found += shard.find(low, high)
            keys, archives, offsets, lengths = zip(*found, strict=True) if found else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(archives, pa.string()),
                 *(pa.array(map(int, x), pa.int64()) for x in (offsets, lengths))],
                names=["key", "file", "offset", "length"])

    routed = ranges.select("low", "high").mapInArrow(route, "shard int, low string, high string")
    # A short row stands for much reading, so the number of parts doesn't follow the bytes.
    return routed.repartitionByRange(task_slots(ranges.sparkSession), "shard", "low").sortWithinPartitions("shard", "low").mapInArrow(
        probe, "key string, file string, offset long, length long")


def fetch(index: CaptureIndex, captures: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of ``captures`` (file, offset, length), by range reads in the order of the files.

    Neighbouring records are read together, up to 4 MB at a time. page_id, url, record_type,
    payload_bytes, payload_digest, refers_to, and with ``payloads`` the payload (null where a
    record revisits another). A response that does not match its digest is an error.
    """
    folder = index.folder
    fields = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
              ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())]
    fields += [("payload", pa.binary())] if payloads else []
    schema = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, " \
             "refers_to long" + ", payload binary" * payloads

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = _Folder(folder)

        def records(run):
            name, start = run[0][0], run[0][1]
            data = store.read(name, start, run[-1][1] + run[-1][2] - start)
            for _, offset, length in run:
                found = read_record(zlib.decompress(data[offset - start:offset - start + length], 31))
                yield {k: found[k] for k, _ in fields}

        def together(rows):
            waiting = []
            for row in rows:
                if waiting and (row[0] != waiting[-1][0] or row[1] != waiting[-1][1] + waiting[-1][2]
                                or row[1] + row[2] - waiting[0][1] > READ_BYTES):
                    yield waiting
                    waiting = []
                waiting.append(row)
            if waiting:
                yield waiting

        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True)
            for part in together(rows):
                yield pa.RecordBatch.from_pylist(list(records(part)), schema=pa.schema(fields))

    # Parts of one file may be read by several tasks.
    part = F.floor(F.col("offset") / (8 * READ_BYTES))
    placed = captures.select("file", "offset", "length").repartition(
        task_slots(captures.sparkSession), "file", part)
    return placed.sortWithinPartitions("file", "offset").mapInArrow(run, schema)


def capture_ranges(pages: DataFrame) -> DataFrame:
    """low, high: the key range of every row's capture, once each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [capture_key(u, i) for u, i in zip(
                batch.column("url").to_pylist(), batch.column("page_id").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(
                [k + "\0" for k in keys], pa.string())], names=["low", "high"])

    return pages.select("url", F.col("page_id").cast("long").alias("page_id")).mapInArrow(
        run, "low string, high string").distinct()


def range_frame(spark: SparkSession, ranges: list[tuple[str, str]]) -> DataFrame:
    """Key ranges of the driver as a frame for ``lookup``."""
    return spark.createDataFrame(ranges, "low string, high string")


def archive(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write every page, then look every capture up in the index and read it back."""
    index = write(pages, min_bytes)
    return fetch(index, lookup(index, capture_ranges(pages)), payloads=False)
