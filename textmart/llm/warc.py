"""WARC archives with a two-level capture index.

`write_archives` stores each page as a WARC/1.1 record, a gzip member of its own, in
archives that tasks write to the shared folder. Of equal payloads of at least
`least_bytes` bytes the page with the largest id is a `response`, all others are `revisit`
records that refer to it and hold no payload. Small payloads are always responses.

`build_index` sorts the captures by their keys, the URL with its host reversed
(`com,example,www)/path?query`) and the page id, into files of compressed blocks of
BLOCK_LINES captures, and keeps a sparse directory: the first key and the place of each
block. `lookup` takes the wanted keys in sorted order, finds the file and by binary search
the block in its directory, reads that range, finds the captures by binary search
in the block. `read_records` takes the captures in order of file and place, joins near ranges
into one read, and parses and verifies the records.

Bounds: a directory has one line for BLOCK_LINES captures and is read by the tasks that
need it; the driver holds one row for each index file, of which there are at most MOST_FILES.
The ids of equal payloads are met by digest and length: where the table of repeated payloads has more than
`broadcast_rows` rows, only those with more than 1/HEAVY of all pages (so fewer than HEAVY)
are broadcast, and the others are joined on payloads that are each a small part of the pages. A file
of an attempt that failed stays unread.

Defined cases: a null payload is empty. A null URL, or one without `://`, has the key `-)` and
itself. A null page id refers to the largest id there is and is a response where none is.
Rows of one id and equal payload are captures of their own and both responses; a key's captures
are all found. Control characters in URLs are written as percent codes. An
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import math
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmart.llm.common import by_value, slices, written
from textmart.session import scratch_path
from textmart.sizes import MAX_BROADCAST_ROWS, is_small

LEAST_BYTES = 1000
ARCHIVE_BYTES = 256 << 20
BLOCK_LINES = 3000
FILE_LINES = 300_000
MOST_FILES = 10_000
HEAVY = 2000
# Ranges of an archive that lie so near are read at once, up to READ_BYTES.
NEAR, READ_BYTES = 64 << 10, 8 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def storage(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", uri))


def url_key(url: Column) -> Column:
    """The URL with its host reversed and lower-cased, without scheme, user and fragment; no blanks."""
    authority = F.lower(F.regexp_extract(url, r"(?s)^.*?://(?:[^/?#@]*@)?([^/?#]*)", 1))
    host, port = F.regexp_extract(authority, r"(?s)^(.*?)(:\d*)?$", 1), F.regexp_extract(authority, r"(?s)^(.*?)(:\d*)?$", 2)
    tail = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    turned = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), port, F.lit(")"), F.when(tail.startswith("/"), tail).otherwise(F.concat(F.lit("/"), tail)))
    key = F.when(url.contains("://"), turned).otherwise(F.concat(F.lit("-)"), F.coalesce(url, F.lit(""))))
    return F.regexp_replace(key, r"[\x00-\x20]", "%20")


def capture_key(url: Column, page_id: Column) -> Column:
    return F.concat(url_key(url), F.lit(" "), F.coalesce(page_id.cast("string"), F.lit("-")))


def record_id(page_id: str, digest: str) -> str:
    return uuid.UUID(bytes=hashlib.md5(f"{page_id} {digest}".encode(), usedforsecurity=False).digest()).urn


def record(page_id: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """A record's gzip member; a revisit has the page's HTTP head but no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<{record_id(page_id, digest)}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url or "about:blank"),
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
        "X-Page-Id": page_id,
    }
    if refers_to is not None:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<{record_id(refers_to, digest)}>", "X-Refers-To-Page-Id": refers_to}
    head |= {"Content-Type": "application/http;msgtype=response", "Content-Length": str(len(block))}
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n"
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(text.encode() + block + b"\r\n\r\n") + packer.flush()


class Record(NamedTuple):
    page_id: str | None
    url: str
    record_type: str
    refers_to: str | None
    payload_bytes: int
    payload_digest: str
    payload: bytes | None


def parsed(member: bytes) -> Record:
    """The record of a gzip member; a response's payload is held against its digest and length."""
    data = zlib.decompress(member, 31)
    text, _, rest = data.partition(b"\r\n\r\n")
    lines = text.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record at this place")
    head = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(head["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)\ncontent-length: *(\d+)", http).group(1))
    digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    revisit = head["WARC-Type"] == "revisit"
    if not revisit:
        found = len(payload), hashlib.sha1(payload, usedforsecurity=False).hexdigest()
        if found != (size, digest):
            raise ValueError(f"damaged record of page {head['X-Page-Id']}")
    known = {"-": None}
    return Record(known.get(head["X-Page-Id"], head["X-Page-Id"]), head["WARC-Target-URI"], head["WARC-Type"], head.get("X-Refers-To-Page-Id"), size, digest, None if revisit else payload)


def marked(pages: DataFrame, least_bytes: int, broadcast_rows: int) -> DataFrame:
    """(page_id, url, html, digest, refers_to): html null for pages that revisit another."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    known = pages.select("page_id", "url", "html", F.sha1(payload.cast("binary")).alias("digest"), F.octet_length(payload).alias("size"))
    repeated = known.where(F.col("size") >= least_bytes).groupBy("digest", "size").agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("pages"))
    repeated = written(repeated.where("pages > 1"), "repeated")
    if is_small(repeated, broadcast_rows):
        met = known.join(F.broadcast(repeated.drop("pages")), ["digest", "size"], "left")
    else:
        most = pages.count() / HEAVY
        heavy = repeated.where(F.col("pages") > most).select("digest", "size", F.col("response").alias("heavy"))
        first = known.join(F.broadcast(heavy), ["digest", "size"], "left")  # fewer than HEAVY rows
        # What is found, or too short to be, meets nothing, in a place of its own.
        done = F.col("heavy").isNotNull() | (F.col("size") < least_bytes)
        place = F.when(done, F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string"))).otherwise(F.col("digest"))
        light = repeated.where(F.col("pages") <= most).select(F.col("digest").alias("place"), F.col("size").alias("_size"), F.col("response").alias("light"))
        second = first.withColumn("place", place).join(light.withColumnRenamed("place", "_place"), (F.col("place") == F.col("_place")) & (F.col("size") == F.col("_size")), "left")
        met = second.withColumn("response", F.coalesce("heavy", "light"))
    other = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    return met.select("page_id", "url", "html", "digest", "size", F.when(other, F.col("response").cast("string")).alias("refers_to"))


def write_archives(pages: DataFrame, root: str, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = LEAST_BYTES, broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """(key, file, offset, length) of each record, one for each page; archives lie below `root`."""
    named = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    rows = marked(named, least_bytes, broadcast_rows).select(capture_key(F.col("url"), F.col("page_id")).alias("key"), F.coalesce(F.col("page_id").cast("string"), F.lit("-")).alias("page_id"), "url", "html", "digest", "refers_to")
    fs, folder = storage(root)
    fs.create_dir(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = storage(root)
        out, name, at = None, None, 0
        for batch in slices(batches, "html"):
            found = []
            for row in batch.to_pylist():
                if out is None or at > ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{folder}/{name}", compression=None)
                member = record(row["page_id"], row["url"], (row["html"] or "").encode(), row["digest"], row["refers_to"])
                out.write(member)
                found.append((row["key"], name, at, len(member)))
                at += len(member)
            yield pa.record_batch([pa.array(c) for c in zip(*found)], names=["key", "file", "offset", "length"])
        if out is not None:
            out.close()

    return written(rows.mapInArrow(by_value(write), "key string, file string, offset long, length long"), "captures")


def tasks(df: DataFrame) -> int:
    """The session's shuffle partitions. Said as a number, they are not made fewer because rows are narrow: each costs a read."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


class Index(NamedTuple):
    """The index files' folder and, in order, their first keys and names; and the archives' folder."""

    folder: str
    firsts: list[str]
    files: list[str]
    archives: str


def build_index(captures: DataFrame, folder: str, archives: str, block_lines: int = BLOCK_LINES, file_lines: int = FILE_LINES) -> Index:
    """Sorted blocks of captures with their directories, in files of about `file_lines` captures."""
    fs, path = storage(folder)
    fs.create_dir(path)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = storage(folder)
        name = f"index-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        lines, directory, at = [], [], 0

        with fs.open_output_stream(f"{path}/{name}.gz", compression=None) as out:

            def put(lines: list, at: int) -> int:
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = packer.compress("".join("\t".join(line) + "\n" for line in lines).encode()) + packer.flush()
                directory.append((lines[0][0], at, len(data)))
                out.write(data)
                return at + len(data)

            for batch in batches:
                for line in zip(*[batch.column(c).cast(pa.string()).to_pylist() for c in ("key", "file", "offset", "length")]):
                    lines.append(line)
                    if len(lines) == block_lines:
                        at, lines = put(lines, at), []
            if lines:
                put(lines, at)
        with fs.open_output_stream(f"{path}/{name}.dir", compression=None) as out:
            out.write("".join(f"{key}\t{at}\t{size}\n" for key, at, size in directory).encode())
        if directory:
            yield pa.record_batch([pa.array([directory[0][0]]), pa.array([name])], names=["first", "file"])

    n_files = max(tasks(captures), min(MOST_FILES, math.ceil(captures.count() / file_lines)))
    rows = captures.repartitionByRange(n_files, "key", "file", "offset").sortWithinPartitions("key", "file", "offset")
    files = written(rows.mapInArrow(by_value(write), "first string, file string"), "index_files")
    # One row for each index file, n_files at most.
    listed = sorted(tuple(r) for r in files.collect())
    return Index(folder, [x[0] for x in listed], [x[1] for x in listed], archives)


class Blocks:
    """The index as one sorted list of blocks, of which the last one read is kept."""

    def __init__(self, index: Index) -> None:
        self.index = index
        self.fs, self.path = storage(index.folder)
        self.file = self.source = self.held = None

    def open(self, file: int) -> None:
        if self.file != file:
            with self.fs.open_input_stream(f"{self.path}/{self.index.files[file]}.dir", compression=None) as source:
                rows = [line.split("\t") for line in source.read().decode().split("\n")[:-1]]
            if self.source is not None:
                self.source.close()
            self.source = self.fs.open_input_file(f"{self.path}/{self.index.files[file]}.gz")
            self.firsts, self.places = [r[0] for r in rows], [(int(r[1]), int(r[2])) for r in rows]
            self.file = file

    def block(self, file: int, number: int) -> tuple[list[str], list[list[str]]]:
        if self.held is None or self.held[0] != (file, number):
            offset, size = self.places[number]
            lines = [line.split("\t") for line in zlib.decompress(self.source.read_at(size, offset), 31).decode().split("\n")[:-1]]
            self.held = (file, number), ([line[0] for line in lines], lines)
        return self.held[1]

    def find(self, wanted: str) -> Iterator[list[str]]:
        """The lines whose key is `wanted`, or of a URL key without a page id all of its captures."""
        file = max(bisect.bisect_left(self.index.firsts, wanted) - 1, 0)
        number = None
        while file < len(self.index.files):
            self.open(file)
            number = max(bisect.bisect_left(self.firsts, wanted) - 1, 0) if number is None else 0
            for n in range(number, len(self.firsts)):
                keys, lines = self.block(file, n)
                i = bisect.bisect_left(keys, wanted)
                while i < len(keys) and (keys[i] == wanted or keys[i].startswith(wanted + " ")):
                    yield lines[i]
                    i += 1
                # A blank sorts before all else in a key: what is found lies together.
                if i < len(keys):
                    return
            file += 1


def lookup(wanted: DataFrame, index: Index, key: str = "key") -> DataFrame:
    """(key, file, offset, length) of the captures of the keys in column `key`, each looked up once."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = Blocks(index)
        for batch in batches:
            found = [line for w in batch.column(0).to_pylist() for line in blocks.find(w)]
            keys, files, offsets, lengths = zip(*found) if found else ([], [], [], [])
            yield pa.record_batch([pa.array(keys, pa.string()), pa.array(files, pa.string()), pa.array(map(int, offsets), pa.int64()), pa.array(map(int, lengths), pa.int64())], names=["key", "file", "offset", "length"])

    keys = written(wanted.select(F.col(key).alias("key")).where("key is not null").distinct(), "wanted")
    rows = keys.repartitionByRange(tasks(keys), "key").sortWithinPartitions("key")
    return written(rows.mapInArrow(by_value(probe), "key string, file string, offset long, length long"), "found")


def read_records(captures: DataFrame, index: Index, payload: bool = True) -> DataFrame:
    """(page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload) of captures that were looked up."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = storage(index.archives)
        name = source = None
        for batch in batches:
            rows = list(zip(*[batch.column(c).to_pylist() for c in ("file", "offset", "length")]))
            i = 0
            while i < len(rows):
                file, start, end = rows[i][0], rows[i][1], rows[i][1] + rows[i][2]
                j = i + 1
                while j < len(rows) and rows[j][0] == file and rows[j][1] <= end + NEAR and rows[j][1] + rows[j][2] - start <= READ_BYTES:
                    end = max(end, rows[j][1] + rows[j][2])
                    j += 1
                if file != name:
                    if source is not None:
                        source.close()
                    name, source = file, fs.open_input_file(f"{folder}/{file}")
                data = source.read_at(end - start, start)
                records = [parsed(data[o - start : o - start + n]) for _, o, n in rows[i:j]]
                columns = list(zip(*records))
                if not payload:
                    columns[-1] = [None] * len(records)
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()])], names=list(Record._fields))
                i = j

    rows = captures.select("file", "offset", "length").repartitionByRange(tasks(captures), "file", "offset").sortWithinPartitions("file", "offset")
    return rows.mapInArrow(by_value(read), "page_id string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload binary")


def archived(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = LEAST_BYTES, broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Pages written to archives and read back through the index: (page_id, payload_bytes, payload_digest, record_type, refers_to)."""
    spark, kind = pages.sparkSession, pages.schema[page_id].dataType
    root = scratch_path(spark, "warc")
    captures = write_archives(pages, f"{root}/archives", page_id, url, html, least_bytes, broadcast_rows)
    index = build_index(captures, f"{root}/index", f"{root}/archives")
    wanted = pages.select(capture_key(F.col(url).cast("string"), F.col(page_id)).alias("key"))
    found = read_records(lookup(wanted, index), index, payload=False)
    return found.select(F.col("page_id").cast(kind), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
