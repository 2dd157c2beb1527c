"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint has 64 bits, cut into three segments of 22, 21 and 21 bits. Four differing bits over
three segments leave two segments that hold two differing bits together at most: drop the one with the most.
Each segment is decoded, with each of its one-bit neighbours, to codewords of the Golay code [23, 12, 7]; segments
that differ by two bits or fewer share a codeword. So a link shares, for one of the three
pairs of segments, a key of two codeword indices. Fingerprints meet on these keys and every
meeting is verified by counting the bits.

Only distinct fingerprints take part, each with its smallest doc_id. Large groups of near copies
share many keys. So neighbours in the order of a key are linked first, which costs a row per key;
what is in one component after that is not paired again.

Edge cases: a null or empty text, or one without words, has fingerprint zero and links like any other.
Rows that share a doc_id are one node. A null doc_id has a fingerprint, links nothing and has
a null component. The bit limit is at most 4, what three segments can promise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlode.llm.components import components
from postlode.llm.golay import nearby
from postlode.llm.shared import batches, byte_texts, discard, lean, stored, texts_of

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
# Lowest bit and width of each segment, and the pairs of segments that make a key.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
PAIRS = ((0, 1), (0, 2), (1, 2))
_LANES = np.uint64(0x0101010101010101)


def _majority(hashes: np.ndarray) -> int:
    """Bits set in over half the hashes; eight counters are added at once, one in each byte."""
    n = len(hashes)
    block = np.arange(0, n, 255)
    result = 0
    for shift in range(8):
        lanes = (hashes >> np.uint64(shift)) & _LANES
        sums = np.add.reduceat(lanes, block)  # no byte passes 255
        counts = sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
        for byte in np.flatnonzero(2 * counts > n):
            result |= 1 << (int(byte) * 8 + shift)
    return result


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    k = min(shingle_words, len(words))
    starts = [0, *(ends[: len(words) - k] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[s:e], SEED) for s, e in zip(starts, ends[k - 1 :].tolist(), strict=True)]
    return _majority(np.array(hashes, np.uint64))


def fingerprints(documents: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, text_hash, fp`` of every row; ``fp`` holds the 64 bits as a signed long."""

    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(iterator):
            found = np.array([fingerprint(t, shingle_words) for t in byte_texts(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(found.view(np.int64))], ["doc_id", "text_hash", "fp"]
            )

    texts = texts_of(documents, F.xxhash64(documents["text"]).alias("text_hash"))
    return texts.mapInArrow(lean(run), "doc_id long, text_hash long, fp long")


def _keys(nodes: DataFrame) -> DataFrame:
    """``key, fp, node``: the codeword-index pairs of every fingerprint."""

    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(iterator):
            signed = batch.column(0).to_numpy(zero_copy_only=False)
            node = batch.column(1).to_numpy(zero_copy_only=False)
            bits = signed.view(np.uint64)
            indices = [
                nearby(((bits >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int32), width)
                for low, width in SEGMENTS
            ]
            for number, (i, j) in enumerate(PAIRS):
                a, b = indices[i][:, :, None], indices[j][:, None, :]
                keys = (number << 24) | (a << 12) | b
                valid = (a >= 0) & (b >= 0)
                rows = np.broadcast_to(np.arange(len(bits))[:, None, None], keys.shape)[valid]
                columns = [pa.array(keys[valid], pa.int32()), pa.array(signed[rows]), pa.array(node[rows])]
                yield pa.RecordBatch.from_arrays(columns, ["key", "fp", "node"])

    return nodes.select("fp", "node").mapInArrow(lean(run, "golay"), "key int, fp long, node long")


def _apart(a, b):
    return F.bit_count(a.bitwiseXOR(b))


def near_groups(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``fp, component`` of every distinct fingerprint that has a document with an id."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the keys find links of up to {MAX_BITS} bits, not {max_bits}")
    nodes = stored(
        prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node")), "fingerprint-nodes"
    )
    # Neighbours in the order of each key.
    order = Window.partitionBy("key").orderBy("fp", "node")
    chain = (
        _keys(nodes)
        .select("node", "fp", F.lag("fp").over(order).alias("fp2"), F.lag("node").over(order).alias("node2"))
        .where(_apart(F.col("fp"), F.col("fp2")) <= max_bits)
        .select(F.col("node").alias("a"), F.col("node2").alias("b"))
    )
    near = stored(components(chain), "near-components")
    grouped = stored(
        nodes.join(near, "node", "left").select("fp", F.coalesce("component", "node").alias("node")), "near-nodes"
    )
    # All meetings on a key between groups that are not yet one.
    keyed = stored(_keys(grouped), "fingerprint-keys")
    left, right = keyed.alias("l"), keyed.alias("r")
    links = left.join(right, F.col("l.key") == F.col("r.key")).where(
        (F.col("l.node") < F.col("r.node")) & (_apart(F.col("l.fp"), F.col("r.fp")) <= max_bits)
    )
    final = stored(components(links.select(F.col("l.node").alias("a"), F.col("r.node").alias("b"))), "far-components")
    discard(keyed)
    return grouped.join(final, "node", "left").select("fp", F.coalesce("component", "node").alias("component"))


def near_duplicates(
    documents: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row."""
    prints = stored(fingerprints(documents, shingle_words), "fingerprints")
    groups = near_groups(prints, max_bits)
    return prints.join(groups, "fp", "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id"),
    )


def one_per_group(documents: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The document with the smallest id of each group, once; rows without an id all stay.

    Of several texts under that id, only one whose own group has the id as its smallest may stand for the
    group: that with the smallest hash. Rows equal in id and text are told apart by their other columns, in the
    order of their JSON. So the result does not depend on the run.
    """
    prints = stored(fingerprints(documents, shingle_words), "fingerprints")
    own = prints.join(near_groups(prints, max_bits), "fp").where("doc_id = component")
    keepers = stored(
        own.groupBy(F.col("doc_id").alias("_keeper"), F.col("text_hash").alias("_text_hash"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("_keeper")
        .agg(F.min(F.struct("_text_hash", "n")).alias("least"))
        .select("_keeper", "least.*"),
        "keepers",
    )

    def rows_of(some: DataFrame) -> DataFrame:
        same = (documents["doc_id"].cast("long") == some["_keeper"]) & (
            F.xxhash64(documents["text"]) == some["_text_hash"]
        )
        return documents.join(some, same, "left_semi")

    others = [documents[c] for c in documents.columns if c not in ("doc_id", "text")]
    # Only rows that occur again under their id meet in an aggregation; the others' texts need none.
    repeated = (
        rows_of(keepers.where("n > 1"))
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.min_by(F.struct("*"), F.to_json(F.struct(*others)) if others else F.lit("")).alias("_row"))
        .select("_row.*")
    )
    return rows_of(keepers.where("n = 1")).unionByName(repeated).unionByName(documents.where("doc_id is null"))
