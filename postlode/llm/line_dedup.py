"""Line dedup by range-partitioned hashes: keep bitmaps instead of texts.

Every line's key is hashed to 128 bits. The hashes are range-partitioned with a secondary sort by
document, the largest first, and by position. A task streams the sorted lines: the first document
of a hash keeps its lines, and once the hash is seen in ``min_docs`` documents the lines
of the others are dropped. Only the first and last hash of a partition may go on in another one;
their document counts are added up over partitions, so a line that fills many partitions
needs no task of its own. Decisions come back per document as a compressed bitmap.

Edge cases: a null or empty text is one empty line. Rows that share a doc_id count as one document,
and each loses the lines of its own text; rows with a null doc_id are one document smaller than all.
An empty table gives an empty result. Lines whose keys are shorter than ``min_chars`` stay.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlode.llm.shared import ASCII_SPACE, batches, byte_texts, free_name, lean, stored, texts_of

MIN_CHARS = 40
MIN_DOCS = 5
LINES = pa.schema([("h", pa.binary()), ("doc_id", pa.int64()), ("of", pa.int64()), ("pos", pa.int32())])
DECISIONS = pa.schema([*LINES, ("edge", pa.int32()), ("n_docs", pa.int32())])
_CONTINUATION = bytes(range(0x80, 0xC0))


def line_key(line: bytes) -> bytes:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    return line.strip(ASCII_SPACE).lower()


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and len(key.translate(None, _CONTINUATION)) >= min_chars


def _hashes(min_chars: int):
    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(iterator):
            rows = []
            for doc, of, text in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), byte_texts(batch.column(2)), strict=True
            ):
                for pos, line in enumerate(text.split(b"\n")):
                    key = line_key(line)
                    if _long_enough(key, min_chars):
                        rows.append((hashlib.blake2b(key, digest_size=16).digest(), doc, of, pos))
            yield _batch(rows, LINES)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _decide(min_docs: int):
    """Stream sorted lines: drops, and what a partition cannot decide of its first and last hash.

    ``edge`` is 0 for a drop, 1 for an undecided line, and 2 for a hash's count of documents and
    largest document in this partition. A hash that begins here has its keeper here, so only lines
    of its first ``min_docs - 1`` documents wait; all lines of the partition's first hash are
    passed on undecided, since it may have begun in an earlier partition.
    """

    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = top = last = None
        first, n_docs, waiting, out = True, 0, [], []

        def finish(is_last: bool) -> None:
            if current is not None and (first or is_last):
                out.extend((current, d, of, pos, 1, None) for d, of, pos in waiting)
                out.append((current, top, None, None, 2, n_docs))

        for batch in batches(iterator):
            for h, doc, of, pos in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if h != current:
                    finish(False)
                    first = current is None
                    current, top, last, n_docs, waiting = h, doc, doc, 1, []
                elif doc != last:
                    last, n_docs = doc, n_docs + 1
                if first:
                    out.append((h, doc, of, pos, 1, None))
                elif n_docs < min_docs:
                    waiting.append((doc, of, pos))
                else:
                    out.extend((h, d, o, p, 0, None) for d, o, p in [*waiting, (doc, of, pos)] if d != top)
                    waiting = []
            if out:
                yield _batch(out, DECISIONS)
                out.clear()
        finish(True)
        if out:
            yield _batch(out, DECISIONS)

    return run


def dropped_lines(documents: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc_id, of, pos`` of every line to drop; ``of`` is the hash of the text it stands in."""
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("of"), "text")
    lines = source.mapInArrow(lean(_hashes(min_chars)), "h binary, doc_id long, of long, pos int")
    ordered = lines.repartitionByRange("h", F.desc_nulls_last("doc_id")).sortWithinPartitions(
        "h", F.desc_nulls_last("doc_id"), "of", "pos"
    )
    decided = "h binary, doc_id long, of long, pos int, edge int, n_docs int"
    seen = stored(ordered.mapInArrow(lean(_decide(min_docs)), decided), "line-decisions")
    # At most two hashes a partition are undecided: a broadcast bounded by the partition count.
    edges = (
        seen.where("edge = 2")
        .groupBy("h")
        .agg(F.sum("n_docs").alias("docs"), F.max("doc_id").alias("keeper"))
        .where(F.col("docs") >= min_docs)
        .select("h", "keeper")
    )
    late = (
        seen.where("edge = 1")
        .join(F.broadcast(edges), "h")
        .where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    )
    return seen.where("edge = 0").select("doc_id", "of", "pos").unionByName(late.select("doc_id", "of", "pos"))


def _pack(positions: list[int]) -> bytes:
    """Positions of dropped lines as a deflated bitmap in which a set bit keeps the line."""
    bits = np.ones((max(positions) // 8 + 1) * 8, np.uint8)
    bits[positions] = 0
    return zlib.compress(np.packbits(bits).tobytes(), 6)


def keep_mask(bitmap: bytes | None, n_lines: int) -> np.ndarray:
    """True for every kept line; lines beyond the bitmap's end are kept."""
    mask = np.ones(n_lines, bool)
    if bitmap is not None:
        bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))[:n_lines]
        mask[: len(bits)] = bits == 1
    return mask


def keep_bitmaps(documents: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc_id, of, keep``: one compressed bitmap for each document that loses lines."""

    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(iterator):
            packed = pa.array([_pack(p) for p in batch.column(2).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed], ["doc_id", "of", "keep"])

    # A document's dropped positions are no more than its own lines.
    dropped = dropped_lines(documents, min_chars, min_docs)
    return dropped.groupBy("doc_id", "of").agg(F.collect_set("pos").alias("at")).mapInArrow(
        lean(run), "doc_id long, of long, keep binary"
    )


def with_bitmaps(documents: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """All columns as they were, then the row's bitmap; null where nothing is dropped."""
    bitmaps = stored(keep_bitmaps(documents, min_chars, min_docs), "line-bitmaps")
    same = documents["doc_id"].cast("long").eqNullSafe(bitmaps["doc_id"]) & (
        F.xxhash64(documents["text"]) == bitmaps["of"]
    )
    # Either side may outgrow any broadcast, so both are shuffled at every size.
    joined = documents.join(bitmaps.hint("merge"), same, "left")
    return joined.select(*[documents[c] for c in documents.columns], bitmaps["keep"].alias(free_name(documents, "keep")))


def kept_text(text: bytes, bitmap: bytes | None) -> tuple[bytes, int, int]:
    """The kept lines joined by a line feed, with the line counts before and dropped."""
    lines = text.split(b"\n")
    if bitmap is None:
        return text, len(lines), 0
    mask = keep_mask(bitmap, len(lines))
    return b"\n".join(x for x, k in zip(lines, mask, strict=True) if k), len(lines), int((~mask).sum())


def digests(documents: DataFrame, **rules: int) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` of every row."""

    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(iterator):
            done = [
                kept_text(t, k) for t, k in zip(byte_texts(batch.column(1)), batch.column(2).to_pylist(), strict=True)
            ]
            columns = [
                batch.column(0), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64()),
                pa.array([hashlib.sha256(d[0]).hexdigest() for d in done], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    masked = with_bitmaps(texts_of(documents), **rules)
    return masked.mapInArrow(lean(run), "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def without_repeats(documents: DataFrame, **rules: int) -> DataFrame:
    """The documents with repeated lines removed from ``text``; other columns as they were."""
    names = documents.columns
    at, keep = names.index("text"), len(names)
    schema = documents.schema

    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(iterator):
            bitmaps = batch.column(keep).to_pylist()
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            kept = [t if k is None or t is None else kept_text(t, k)[0] for t, k in zip(texts, bitmaps, strict=True)]
            columns = list(batch.columns[:keep])
            columns[at] = pa.array(kept, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return with_bitmaps(documents, **rules).mapInArrow(lean(run), schema)
