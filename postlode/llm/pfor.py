"""Token ids in files of patched frame-of-reference blocks.

A file holds documents in ascending doc_id order. Their ids, each document's end id included, run on through blocks
of ``BLOCK`` ids. A block stores its minimum and the differences to it, packed at the width that holds
``PERCENTILE`` per cent of them. Larger ones keep their low bits there and put the rest
into an exception list of places and high bits. After the blocks come the index of block starts and the index
of documents, so a reader finds any document with two look-ups. Layout, little-endian::

    "PFR1" | blocks | block starts (u64 each) | doc ids (i64 each) | ids before each doc (u64 each, and the total)
           | n_blocks u64 | n_docs u64 | null ids at the front u64 | length of all this u64 | "PFR1"
    block: n u32 | minimum u32 | width u8 | n_exceptions u16 | packed differences | places u16 each | high bits u32 each

Tasks write files of their own under names that no other attempt has, and return a manifest row for each;
files that are not in the manifest, of lost or repeated attempts, do not count.

Edge cases: null and empty texts are a document of the end id alone. Null doc_ids come first. Rows that share a
doc_id are documents of their own, in the order of their texts. An empty table makes no file.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlode.llm.shared import batches, filesystem, lean, new_path, stored, texts_of
from postlode.llm.tokens import encoder, text_groups

MAGIC = b"PFR1"
BLOCK = 4096
PERCENTILE = 95
END_ID = 1
MANIFEST = "part int, file string, n_docs long, n_ids long"
_HEAD = "<IIBH"


def pack_block(values: np.ndarray) -> bytes:
    """One block of up to 65,535 unsigned 32-bit values."""
    low = int(values.min())
    rest = (values - np.uint32(low)).astype(np.uint32)
    cut = int(np.partition(rest, k := (len(rest) - 1) * PERCENTILE // 100)[k])
    width = cut.bit_length()
    over = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
    bits = np.unpackbits(rest.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)[:, 32 - width :]
    return b"".join(
        [
            struct.pack(_HEAD, len(values), low, width, len(over)),
            np.packbits(bits).tobytes(),
            over.astype("<u2").tobytes(),
            (rest[over] >> np.uint32(width)).astype("<u4").tobytes(),
        ]
    )


def unpack_block(data: bytes, at: int) -> np.ndarray:
    n, low, width, n_over = struct.unpack_from(_HEAD, data, at)
    at += struct.calcsize(_HEAD)
    size = (n * width + 7) // 8
    bits = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=n * width).reshape(n, width)
    full = np.zeros((n, 32), np.uint8)
    full[:, 32 - width :] = bits
    values = np.packbits(full, axis=1).view(">u4").ravel().astype(np.uint32)
    at += size
    if n_over:
        places = np.frombuffer(data, "<u2", n_over, at)
        values[places] |= np.frombuffer(data, "<u4", n_over, at + 2 * n_over) << np.uint32(width)
    return values + np.uint32(low)


class Writer:
    """Writes one file; holds a block of ids and the indexes."""

    def __init__(self, path: str):
        fs, name = filesystem(path)
        fs.create_dir(name.rpartition("/")[0], recursive=True)
        self._out = fs.open_output_stream(name)
        self._out.write(MAGIC)
        self._at = len(MAGIC)
        self._pending: list[np.ndarray] = []
        self._n_pending = 0
        self._blocks: list[int] = []
        self._docs: list[int] = []
        self._before = [0]
        self._nulls = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self._nulls += doc_id is None
        self._docs.append(doc_id or 0)
        self._before.append(self._before[-1] + len(ids))
        self._pending.append(ids)
        self._n_pending += len(ids)
        if self._n_pending >= 64 * BLOCK:
            self._flush(False)

    def _flush(self, all_of_it: bool) -> None:
        ids = np.concatenate(self._pending) if self._pending else np.empty(0, np.uint32)
        end = len(ids) if all_of_it else len(ids) - len(ids) % BLOCK
        for low in range(0, end, BLOCK):
            block = pack_block(ids[low : min(low + BLOCK, end)])
            self._blocks.append(self._at)
            self._out.write(block)
            self._at += len(block)
        self._pending, self._n_pending = [ids[end:]], len(ids) - end

    def close(self) -> tuple[int, int]:
        self._flush(True)
        parts = [
            np.array(self._blocks, "<u8").tobytes(), np.array(self._docs, "<i8").tobytes(),
            np.array(self._before, "<u8").tobytes(), struct.pack("<QQQ", len(self._blocks), len(self._docs), self._nulls),
        ]
        index = b"".join(parts)
        self._out.write(index + struct.pack("<Q", len(index)) + MAGIC)
        self._out.close()
        return len(self._docs), self._before[-1]


class Reader:
    """Reads the documents of one file in order, or one document by its place."""

    def __init__(self, path: str):
        fs, name = filesystem(path)
        self._in = fs.open_input_file(name)
        size = self._in.size()
        tail = self._in.read_at(12, size - 12)
        if tail[8:] != MAGIC or self._in.read_at(4, 0) != MAGIC:
            raise ValueError(f"{path} is not a complete token file")
        (length,) = struct.unpack("<Q", tail[:8])
        index = self._in.read_at(length, size - 12 - length)
        n_blocks, n_docs, self._nulls = struct.unpack("<QQQ", index[-24:])
        self._blocks = np.append(np.frombuffer(index, "<u8", n_blocks), size - 12 - length).astype(np.int64)
        self._docs = np.frombuffer(index, "<i8", n_docs, 8 * n_blocks)
        self.before = np.frombuffer(index, "<u8", n_docs + 1, 8 * (n_blocks + n_docs)).astype(np.int64)

    def __len__(self) -> int:
        return len(self._docs)

    def doc_id(self, place: int) -> int | None:
        return None if place < self._nulls else int(self._docs[place])

    def _read(self, first: int, last: int) -> np.ndarray:
        """Ids of the blocks from ``first`` up to ``last``."""
        start = int(self._blocks[first])
        data = self._in.read_at(int(self._blocks[last]) - start, start)
        return np.concatenate([unpack_block(data, int(at) - start) for at in self._blocks[first:last]])

    def ids(self, place: int) -> np.ndarray:
        low, high = int(self.before[place]), int(self.before[place + 1])
        if low == high:
            return np.empty(0, np.uint32)
        first, last = low // BLOCK, (high - 1) // BLOCK + 1
        return self._read(first, last)[low - first * BLOCK : high - first * BLOCK]

    def documents(self, blocks: int = 64) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """``doc_id, ids before it in the file, ids`` of all documents, some blocks at a time."""
        held, base, after = np.empty(0, np.uint32), 0, 0
        for place in range(len(self)):
            low, high = int(self.before[place]), int(self.before[place + 1])
            while base + len(held) < high:
                more = self._read(after, min(after + blocks, len(self._blocks) - 1))
                held, base = np.concatenate([held[low - base :], more]), low
                after = min(after + blocks, len(self._blocks) - 1)
            yield self.doc_id(place), low, held[low - base : high - base]


def write_tokens(documents: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Write token files to the shared folder; the stored manifest has a row per file, in order."""
    folder = new_path(documents.sparkSession, "tokens")

    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokens = encoder(tokenizer_path, False)
        part = TaskContext.get().partitionId()
        path = f"{folder}/{part:06d}-{uuid.uuid4().hex}.pfr"
        writer = None
        for batch in batches(iterator):
            writer = writer or Writer(path)
            ids, row = batch.column(0).to_pylist(), 0
            for group in text_groups(batch.column(1)):
                for own, _ in tokens.encode(group):
                    writer.add(ids[row], np.append(own, np.uint32(end_id)))
                    row += 1
        if writer:
            n_docs, n_ids = writer.close()
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "file": path, "n_docs": n_docs, "n_ids": n_ids}],
                schema=pa.schema(
                    [("part", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]
                ),
            )

    ordered = texts_of(documents).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return stored(ordered.mapInArrow(lean(run, "encoder"), MANIFEST), "token-manifest")


def read_tokens(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files, and its ids if asked for."""
    # One row per file: the window orders as many rows as there were partitions.
    before = F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files = stored(manifest.select("file", F.coalesce(before, F.lit(0)).alias("base")), "token-files")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    names = [x.split()[0] for x in schema.split(", ")]

    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64()] * 4 + [pa.binary()] * with_ids
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches(iterator):
            for file, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = []
                for doc_id, low, ids in Reader(file).documents():
                    data = ids.astype("<u4").tobytes()
                    rows.append((doc_id, base + low, len(ids), zlib.crc32(data), *([data] if with_ids else [])))
                    if len(rows) == 1000:
                        yield flush(rows)
                        rows = []
                if rows:
                    yield flush(rows)

    # A partition per file; without the number, a few rows of names would all go to one task.
    return files.repartition(max(1, files.count()), "file").mapInArrow(run, schema)
