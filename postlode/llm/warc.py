"""WARC archives: a writer with revisit records, and a salvage reader.

Each record is a gzip member of its own. A task writes files under names no other attempt has and
returns a manifest row for each; files of lost attempts are in no manifest.

The reader takes byte ranges of files. A range owns the members that start in it; from a
start inside the file it first searches for one. When a member or a record fails its checks, namely inflating,
the gzip checksum, the header, the block length and the block and payload digests, the reader
searches for the next place from which a valid record can be read, goes on there and logs the bytes
between as a gap. A gap is logged by the range that owns the record before it. Plain files
are read the same way by their version lines, each as one range.

Edge cases: a null payload is empty; a null url has no target line. A null id is written as an empty id and reads
back as null; it is never the record that others refer to. Rows that repeat the smallest id are all
responses. An empty table gives no files.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlode.llm.shared import batches, filesystem, new_path, stored

# Smaller payloads are always stored in full.
REVISIT_BYTES = 100
FILE_BYTES = 64 << 20
SPLIT_BYTES = 32 << 20
LEVEL = 6
# Pages carry no time of capture.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, n_bytes long, n_records long"
RECORDS = (
    "file string, at long, n_bytes long, gap string, record_type string, record_id string, target_uri string, "
    "refers_to string, payload_bytes long, payload_digest string, payload binary"
)
_MAGIC = b"\x1f\x8b\x08"
_VERSION = re.compile(rb"WARC/1\.[0-9]\r\n")
_ID = "<urn:page:{}>"


def page_records(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``page_id, url, payload, digest, refers_to``: what to write for ``page_id, url, html`` rows."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest")
    )
    # Counted before the shuffle; only digests of several ids go on.
    first = (
        rows.where((F.length("payload") >= revisit_bytes) & F.col("page_id").isNotNull())
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.max("page_id").alias("last_id"))
        .where("first_id <> last_id")
        .select("digest", "first_id")
    )
    # A payload that a third of the pages share is one hot key here; AQE splits the pages' side.
    joined = rows.join(first.hint("merge"), "digest", "left")
    other = F.col("page_id").isNull() | (F.col("page_id") > F.col("first_id"))
    return joined.select("page_id", "url", "payload", "digest", F.when(other, F.col("first_id")).alias("refers_to"))


def _sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A whole record; a revisit's block is the HTTP header alone, which tells the payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    header = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}"]
    header.append("WARC-Record-ID: " + _ID.format("" if page_id is None else page_id))
    header.append(f"WARC-Date: {DATE}")
    if url is not None:
        # Control characters and blanks would end the line or the value.
        header.append("WARC-Target-URI: " + quote(url, safe="".join(map(chr, range(0x21, 0x7F))).replace("%", "") + "%"))
    if refers_to is not None:
        header += ["WARC-Refers-To: " + _ID.format(refers_to), f"WARC-Profile: {PROFILE}"]
    header += [
        f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{_sha256(block)}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", "",
    ]
    return "\r\n".join(header).encode() + block + b"\r\n\r\n"


def write_archives(records: DataFrame, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write records to files in the shared folder; the stored manifest has a row per file."""
    folder = new_path(records.sparkSession, "warc")

    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, size, count = None, "", 0, 0
        done: list[tuple[str, int, int]] = []
        for batch in batches(iterator):
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                    files, name = filesystem(path)
                    files.create_dir(name.rpartition("/")[0], recursive=True)
                    out, size, count = files.open_output_stream(name, compression=None), 0, 0
                packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                member = packer.compress(record_bytes(*row)) + packer.flush()
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= file_bytes:
                    out.close()
                    done.append((path, size, count))
                    out = None
        if out is not None:
            out.close()
            done.append((path, size, count))
        if done:
            files, sizes, counts = zip(*done, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(files), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], ["file", "n_bytes", "n_records"]
            )

    chosen = records.select("page_id", "url", "payload", "digest", "refers_to")
    return stored(chosen.mapInArrow(run, MANIFEST), "warc-manifest")


class Damaged(ValueError):
    """A record failed a check."""


@dataclass
class Record:
    at: int
    end: int
    headers: dict[str, str]
    block: bytes

    @property
    def payload(self) -> bytes:
        return self.block.partition(b"\r\n\r\n")[2]

    @property
    def payload_bytes(self) -> int:
        if self.headers.get("warc-type") != "revisit":
            return len(self.payload)
        found = re.search(rb"(?im)^content-length: *([0-9]+)", self.block)
        return int(found[1]) if found else 0


def parse_record(data: bytes, at: int, end: int) -> tuple[dict[str, str], bytes, int]:
    """Header, block and end of the record at ``data[at:end]``, all checks passed."""
    if not _VERSION.match(data, at, end):
        raise Damaged("no version line")
    close = data.find(b"\r\n\r\n", at, end)
    if close < 0:
        raise Damaged("no end of header")
    headers: dict[str, str] = {}
    for line in data[at:close].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("bad header line")
        headers[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    length = headers.get("content-length", "")
    if not length.isdecimal():
        raise Damaged("no content length")
    start, stop = close + 4, close + 4 + int(length)
    if data[stop : min(stop + 4, end)] != b"\r\n\r\n":
        raise Damaged("block length")
    block = bytes(data[start:stop])
    for name, part in (("warc-block-digest", block), ("warc-payload-digest", block.partition(b"\r\n\r\n")[2])):
        kind, _, value = headers.get(name, "").partition(":")
        if name == "warc-payload-digest" and headers.get("warc-type") == "revisit":
            continue
        if kind == "sha256" and value != _sha256(part):
            raise Damaged(name)
    return headers, block, stop + 4


class Source:
    """Bytes of a file from ``start`` on, read as they are asked for."""

    def __init__(self, file: fs.NativeFile, start: int, ahead: int = 1 << 20):
        self._file, self.start, self._ahead = file, start, ahead
        self.size = file.size()
        self.data = bytearray()

    def fill(self, to: int) -> int:
        """Have the bytes up to ``to``, or the end; where the data ends."""
        have = self.start + len(self.data)
        if to > have and have < self.size:
            self.data += self._file.read_at(min(max(to - have, self._ahead), self.size - have), have)
        return self.start + len(self.data)

    def drop(self, before: int) -> None:
        if before - self.start > 4 * self._ahead:
            del self.data[: before - self.start]
            self.start = before


def read_member(source: Source, at: int) -> Record:
    """The record in the gzip member that starts at ``at``."""
    unpacker, parts, pos = zlib.decompressobj(31), [], at
    try:
        while not unpacker.eof:
            have = source.fill(pos + (1 << 16))
            if pos >= have:
                raise Damaged("cut off")
            piece = bytes(source.data[pos - source.start : min(pos + (1 << 16), have) - source.start])
            parts.append(unpacker.decompress(piece))
            if pos == at and not _VERSION.match(parts[0]) and len(parts[0]) >= 10:
                raise Damaged("no version line")
            pos += len(piece)
    except zlib.error as error:
        raise Damaged(f"gzip: {error}") from None
    data = b"".join(parts)
    headers, block, end = parse_record(data, 0, len(data))
    if end != len(data):
        raise Damaged("more than a record")
    return Record(at, pos - len(unpacker.unused_data), headers, block)


def read_plain(source: Source, at: int) -> Record:
    """The record whose version line is at ``at`` of a plain file."""
    need = at + (1 << 16)
    while True:
        have = source.fill(need)
        try:
            headers, block, end = parse_record(bytes(source.data), at - source.start, len(source.data))
            return Record(at, source.start + end, headers, block)
        except Damaged as error:
            # It may only be that the data in memory ends too early.
            if have >= source.size or str(error) not in ("no end of header", "block length"):
                raise
            stated = re.search(rb"(?i)\ncontent-length: *([0-9]{1,15})\r\n", source.data[at - source.start : at - source.start + (1 << 16)])
            wanted = at + (1 << 16) + (int(stated[1]) if stated else 0)
            if wanted <= have:
                raise
            need = min(wanted, source.size)


def salvage(file: fs.NativeFile, start: int, end: int, packed: bool) -> Iterator[Record | tuple[int, int, str]]:
    """Records that start in ``[start, end)``, and ``(from, to, reason)`` for each gap behind one of them."""
    source = Source(file, start)
    read, mark = (read_member, _MAGIC) if packed else (read_plain, b"WARC/1.")

    def search(at: int, limit: int | None) -> Record | None:
        """The first valid record at or after ``at``, starting before ``limit`` if one is given."""
        while True:
            have = source.fill(at + (1 << 16))
            found = source.data.find(mark, at - source.start)
            if found < 0:
                at = max(at, have - len(mark) + 1)
                if have >= source.size or (limit is not None and at >= limit):
                    return None
                source.drop(at)
                continue
            place = source.start + found
            if limit is not None and place >= limit:
                return None
            try:
                return read(source, place)
            except Damaged:
                at = place + 1

    at, owner = start, start == 0
    while at < min(end, source.size) or (owner and at < source.size):
        source.drop(at)
        try:
            record, reason = read(source, at), ""
        except Damaged as error:
            # Before the first record of a later range, the gap is another range's.
            record, reason = search(at + 1, None if owner else end), str(error)
        stop = record.at if record else source.size
        if stop > at and owner:
            yield at, stop, reason
        if record is None or record.at >= end:
            return
        yield record
        at, owner = record.end, True


def read_archives(files: DataFrame, with_payload: bool = False, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Records and gaps of the files in ``file, n_bytes`` rows.

    A gap's row has its reason in ``gap``, its place and length, and null elsewhere. Names that end in ``.gz`` are
    cut into ranges of ``split_bytes``.
    """
    ranged = files.select(
        "file",
        F.explode(
            F.when(F.col("file").endswith(".gz"), F.sequence(F.lit(0), F.greatest(F.col("n_bytes") - 1, F.lit(0)), F.lit(split_bytes)))
            .otherwise(F.array(F.lit(0).cast("long")))
        ).alias("at"),
    )
    names = [x.split()[0] for x in RECORDS.split(", ")]

    def row(path: str, found: Record | tuple[int, int, str]) -> tuple:
        if isinstance(found, tuple):
            return (path, found[0], found[1] - found[0], found[2], *[None] * 7)
        h = found.headers
        payload = None if h.get("warc-type") == "revisit" or not with_payload else found.payload
        digest = h.get("warc-payload-digest", "").partition(":")[2]
        return (
            path, found.at, found.end - found.at, None, h.get("warc-type"), h.get("warc-record-id"),
            h.get("warc-target-uri"), h.get("warc-refers-to"), found.payload_bytes,
            digest or _sha256(found.payload), payload,
        )

    schema = pa.schema(
        [("file", pa.string()), ("at", pa.int64()), ("n_bytes", pa.int64()), ("gap", pa.string()),
         ("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()),
         ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
    )

    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(iterator):
            for path, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                where, name = filesystem(path)
                packed = path.endswith(".gz")
                with where.open_input_file(name) as file:
                    rows, size = [], 0
                    for found in salvage(file, at, at + split_bytes if packed else 1 << 62, packed):
                        rows.append(row(path, found))
                        size += len(rows[-1][-1] or b"")
                        if len(rows) == 1000 or size > 16 << 20:
                            yield _table(rows, schema)
                            rows, size = [], 0
                    if rows:
                        yield _table(rows, schema)

    assert [f.name for f in schema] == names
    # A partition per range; without the number, a few rows of names would all go to one task.
    return ranged.repartition(max(1, ranged.count()), "file", "at").mapInArrow(run, RECORDS)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
    )


def archive_files(spark: SparkSession, folder: str) -> DataFrame:
    """``file, n_bytes`` of the archives below a folder, for archives that came from elsewhere."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return found.select(F.col("path").alias("file"), F.col("length").alias("n_bytes"))


def page_number(column: str):
    """The page id in a record id as this writer makes it; null for none."""
    return F.regexp_extract(column, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
