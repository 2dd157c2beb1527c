"""Alignment of the ids that two tokenizers give the same bytes.

Both tokenizers cover a text's bytes, so each id has a byte offset where it ends. Offsets where ids of both end cut
the ids into groups. Most groups have one id of each, and then the end arrays agree at a fixed shift of
their indices, along a diagonal. From where two ends agree the run is measured by exponential probing: stretches of
1, 2, 4, ... ends are compared at once until one differs, which is halved until the run's length is known. An
irregular group is resolved one id at a time, the side that ends first going on; the next run has the new shift.
Texts are aligned many at a time, one behind the other.

Ids whose ranges end together are linked. How often two ids are linked in all documents is counted per chunk
of documents first and then summed; each chunk gets the counts of its own pairs back.

Edge cases: null and empty texts, and texts that the ids' bytes do not give back (those with the sign that the second
tokenizer writes for a space, for one), have no ids and zeros in all counts. Repeated ids of documents are rows of
their own. A null doc_id is a document like others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from postlode.llm.shared import batches, stored, texts_of, worker_cache
from postlode.llm.tokens import byte_alphabet, encoder, text_groups

CHUNK_BYTES = 8 << 20
ALIGNED_BYTES = 1 << 20  # of texts that are aligned at once
SPACE_SIGN = "▁"
_B_BITS = 32  # of a pair's code, the lower ones hold the second id
_MOST_IDS = 10**7  # an id of seven digits and a separator fill eight bytes


def diagonal_runs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``start in a, start in b, length`` of the stretches where the ascending ends agree at one shift.

    The last ends must be equal. What lies between two runs belongs to the group that the next run's first ends close.
    """
    b = b.astype(a.dtype, copy=False)
    a_list, b_list = a.tolist(), b.tolist()
    a_bytes, b_bytes, one = a.tobytes(), b.tobytes(), a.itemsize
    count, end = len(a_list), len(a_bytes)
    i = j = 0
    starts_a, starts_b, lengths = [], [], []
    while i < count:
        x, y = a_list[i], b_list[j]
        while x != y:
            if x < y:
                i += 1
                x = a_list[i]
            else:
                j += 1
                y = b_list[j]
        at, to, step = one * (i + 1), one * (j + 1), one
        # Behind the last end a stretch is cut short; one side's alone is then unlike the other's.
        while at < end and a_bytes[at : at + step] == b_bytes[to : to + step]:
            at += step
            to += step
            step += step
        at = min(at, end)
        while step > one and at < end:
            step >>= 1
            if a_bytes[at : at + step] == b_bytes[to : to + step]:
                at += step
                to += step
        done = min(at, end) // one - i
        starts_a.append(i)
        starts_b.append(j)
        lengths.append(done)
        i += done
        j += done
    return tuple(np.array(x, np.int64) for x in (starts_a, starts_b, lengths))


def group_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each group the indices of its last ids."""
    starts_a, starts_b, lengths = diagonal_runs(a, b)
    within = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return np.repeat(starts_a, lengths) + within, np.repeat(starts_b, lengths) + within


class _Entries:
    """The bytes of each id, one behind the other."""

    def __init__(self, entries: list[bytes]):
        self._flat = np.frombuffer(b"".join(entries), np.uint8)
        self.sizes = np.array([len(x) for x in entries], np.int32)
        self._starts = np.cumsum(self.sizes, dtype=np.int64) - self.sizes

    def joined(self, ids: np.ndarray) -> bytes:
        sizes = self.sizes[ids]
        places = np.cumsum(sizes, dtype=np.int64)
        shift = np.repeat(self._starts[ids] - (places - sizes), sizes)
        return self._flat[shift + np.arange(len(shift))].tobytes()


class TokenizerPair:
    """A byte-level vocabulary, which reads a space and the text, and a piece model, which adds the space."""

    def __init__(self, byte_level: str, pieces: str):
        self._a = encoder(byte_level, True)
        self._b = SentencePieceProcessor(model_file=pieces)
        alphabet = byte_alphabet()
        vocabulary = Tokenizer.from_file(byte_level).get_vocab(with_added_tokens=True)
        first = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            known = all(c in alphabet for c in token)
            first[number] = bytes(alphabet[c] for c in token) if known else token.encode()
        second = []
        for number in range(self._b.get_piece_size()):
            piece = self._b.id_to_piece(number)
            byte = self._b.is_byte(number)
            second.append(bytes([int(piece[1:-1], 16)]) if byte else piece.replace(SPACE_SIGN, " ").encode())
        if max(len(first), len(second)) > _MOST_IDS:
            raise ValueError(f"ids of {_MOST_IDS} and more are not written")
        self._entries = _Entries(first), _Entries(second)

    def align(self, texts: pa.Array) -> Alignment:
        plain = texts.to_pylist()
        there = [k for k, t in enumerate(plain) if t]
        spaced = [" " + plain[k] for k in there]
        a_ids = [ids.astype(np.int32) for ids, _ in self._a.encode(pa.array(spaced, pa.string()))]
        b_ids = self._b.encode([plain[k] for k in there], num_threads=1)
        whole = [x.encode() for x in spaced]
        sides = a_ids, [np.array(x, np.int32) for x in b_ids]
        none = np.empty(0, np.int32)
        flat = [np.concatenate([none, *ids]) for ids in sides]
        if any(e.joined(ids) != b"".join(whole) for e, ids in zip(self._entries, flat, strict=True)):
            for k, text in enumerate(whole):
                if any(e.joined(ids[k]) != text for e, ids in zip(self._entries, sides, strict=True)):
                    for ids in sides:
                        ids[k] = none
            flat = [np.concatenate([none, *ids]) for ids in sides]
        counts = np.zeros((2, len(plain)), np.int64)
        for side, ids in zip(counts, sides, strict=True):
            side[there] = [len(x) for x in ids]
        (a, b), (n_a, n_b) = flat, counts
        ends, others = (np.cumsum(e.sizes[ids], dtype=np.int32) for e, ids in zip(self._entries, flat, strict=True))
        last_a, last_b = group_ends(ends, others)
        # A text's groups are those whose last id is one of its own.
        reached = np.searchsorted(last_a, np.cumsum(n_a), side="left")
        n_groups = np.diff(np.concatenate([[0], reached]))
        return Alignment(a, b, n_a, n_b, n_groups, last_a, last_b, ends)


@dataclass
class Alignment:
    """The ids of several texts in a row, the ids per text, and each group's last ids."""

    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    last_a: np.ndarray
    last_b: np.ndarray
    ends: np.ndarray  # byte offsets over all texts, a space before each, where ids of ``a`` end

    def links(self) -> np.ndarray:
        """Codes of the linked ids, a link per group: no id is without bytes, so no two of a side end together."""
        return (self.a[self.last_a].astype(np.int64) << _B_BITS) | self.b[self.last_b]

    def written(self) -> list[bytes]:
        """Each text's groups: ``a1,a2|b1;a3|b2,b3``."""
        groups = len(self.last_a)
        of_a = np.repeat(np.arange(groups), np.diff(self.last_a, prepend=-1))
        of_b = np.repeat(np.arange(groups), np.diff(self.last_b, prepend=-1))
        before = np.concatenate([[0], self.last_b[:-1] + 1]) if groups else self.last_b
        at_a, at_b = np.arange(len(self.a)), np.arange(len(self.b))
        out = np.empty(len(self.a) + len(self.b), np.uint64)
        place_a, place_b = at_a + before[of_a], at_b + (self.last_a + 1)[of_b]
        bits = int(max(self.a.max(initial=0), self.b.max(initial=0))).bit_length()
        comma, bar, semicolon = (_digits(s, bits) for s in ",|;")
        out[place_a] = np.where(at_a == self.last_a[of_a], bar[self.a], comma[self.a])
        out[place_b] = np.where(at_b == self.last_b[of_b], semicolon[self.b], comma[self.b])
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        return [
            out[low:high].tobytes().translate(None, b"\0")[:-1]
            for low, high in zip([0, *ends[:-1]], ends, strict=True)
        ]


@cache
def _digits(separator: str, bits: int) -> np.ndarray:
    """Eight bytes for each id of so many bits: its decimal digits, the separator, and zeros."""
    return np.array([f"{i}{separator}".encode() for i in range(1 << bits)], "S8").view("<u8")


def tokenizer_pair(byte_level: str, pieces: str) -> TokenizerPair:
    """One per worker process."""
    made, key = worker_cache(), ("pair", byte_level, pieces)
    if key not in made:
        made[key] = TokenizerPair(byte_level, pieces)
    return made[key]


def groups(documents: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """Each document's ids, with every group's number of ids and the byte of the text where it ends."""

    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizer_pair(byte_level, pieces)
        for batch in batches(iterator):
            low = 0
            for texts in text_groups(batch.column(1), ALIGNED_BYTES):
                found = pair.align(texts)
                ends = found.ends[found.last_a] - 1  # without the leading space
                starts = np.concatenate([[0], np.cumsum(found.n_groups)])
                first = np.concatenate([[0], found.ends])[np.concatenate([[0], np.cumsum(found.n_a)])[:-1]]
                sizes = [np.diff(x, prepend=-1) for x in (found.last_a, found.last_b)]
                lists = [
                    (found.a, np.cumsum(found.n_a)), (found.b, np.cumsum(found.n_b)),
                    (sizes[0], starts[1:]), (sizes[1], starts[1:]), (ends - np.repeat(first, found.n_groups), starts[1:]),
                ]
                columns = [
                    pa.ListArray.from_arrays(np.concatenate([[0], c]).astype(np.int32), pa.array(v, pa.int64()))
                    for v, c in lists
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, len(texts)), *columns],
                    ["doc_id", "a_ids", "b_ids", "a_sizes", "b_sizes", "ends"],
                )
                low += len(texts)

    schema = "doc_id long, a_ids array<long>, b_ids array<long>, a_sizes array<long>, b_sizes array<long>, ends array<long>"
    return texts_of(documents).mapInArrow(run, schema)


DOCUMENT = "struct<doc_id: long, n_a: long, n_b: long, n_groups: long, groups_sha256: string>"
CHUNK = f"chunk long, documents array<{DOCUMENT}>, pairs array<long>, counts array<long>, links binary"


def _packed(numbers: np.ndarray) -> bytes:
    """Small numbers mostly: their low bytes first, then the next ones, compressed."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data, max_output_size=max(1, 4 * n)), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").ravel()


def _chunks(documents: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """Documents in chunks: their counts and digests, the chunk's distinct pairs, and each document's links as
    numbers among these pairs, frequent pairs first."""

    def chunk(number: int, ids: list[pa.Array], parts: list[tuple]) -> pa.RecordBatch:
        n_a, n_b, n_groups = (np.concatenate([p[k] for p in parts]) for k in range(3))
        digests = [d for p in parts for d in p[3]]
        own, where, times = zip(*(p[4] for p in parts), strict=True)
        pairs, place = np.unique(np.concatenate(own), return_inverse=True)
        counts = np.bincount(place, np.concatenate(times), len(pairs)).astype(np.int64)
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(pairs), np.uint32)
        rank[order] = np.arange(len(pairs), dtype=np.uint32)
        firsts = np.cumsum([0, *(len(x) for x in own)]).tolist()
        numbers = [rank[place[low : low + len(x)]][w] for low, x, w in zip(firsts, own, where)]
        rows = pa.StructArray.from_arrays(
            [pa.concat_arrays(ids), *(pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups)), pa.array(digests)],
            ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256"],
        )
        columns = [
            pa.array([number]), pa.ListArray.from_arrays([0, len(rows)], rows),
            *(pa.ListArray.from_arrays([0, len(x)], pa.array(x, pa.int64())) for x in (pairs[order], counts[order])),
            pa.array([_packed(np.concatenate(numbers))], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["chunk", "documents", "pairs", "counts", "links"])

    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pair = tokenizer_pair(byte_level, pieces)
        number = TaskContext.get().partitionId() << 33
        ids, parts, size = [], [], 0
        for batch in batches(iterator):
            low = 0
            for texts in text_groups(batch.column(1), ALIGNED_BYTES):
                found = pair.align(texts)
                digests = [hashlib.sha256(g).hexdigest() if g else "" for g in found.written()]
                ids.append(batch.column(0).slice(low, len(texts)))
                pairs, where, times = np.unique(found.links(), return_inverse=True, return_counts=True)
                parts.append((found.n_a, found.n_b, found.n_groups, digests, (pairs, where.astype(np.uint32), times)))
                low += len(texts)
                size += (pc.sum(pc.binary_length(texts)).as_py() or 0) + 16 * len(texts)
                if size >= CHUNK_BYTES:
                    yield chunk(number, ids, parts)
                    number, ids, parts, size = number + 1, [], [], 0
        if ids:
            yield chunk(number, ids, parts)

    return texts_of(documents).mapInArrow(run, CHUNK)


def _counted(chunks: DataFrame) -> DataFrame:
    """``pair, count, best``: links of each pair in all chunks, and whether its second id has no more frequent one."""
    each = chunks.select(F.inline(F.arrays_zip("pairs", "counts")))
    totals = each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("counts").alias("count"))
    second = F.col("pair").bitwiseAND((1 << _B_BITS) - 1)
    highest = totals.groupBy(second.alias("b")).agg(F.max("count").alias("highest"))
    joined = totals.withColumn("b", second).join(highest, "b")
    return joined.select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def id_pairs(documents: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """``a, b, count, best`` of every pair of ids that a link holds."""
    counted = _counted(stored(_chunks(documents, byte_level, pieces), "alignment-chunks"))
    second = F.col("pair").bitwiseAND((1 << _B_BITS) - 1)
    return counted.select(F.shiftright("pair", _B_BITS).alias("a"), second.alias("b"), "count", "best")


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def digests(documents: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """Per document its ids, groups and links, the links that are their second id's best, the sum of all links'
    counts, and the digest of its groups."""
    chunks = stored(_chunks(documents, byte_level, pieces), "alignment-chunks")
    counted = _counted(chunks).select("pair", (2 * F.col("count") + F.col("best").cast("long")).alias("value"))
    asked = chunks.select("chunk", F.posexplode("pairs").alias("at", "pair"))
    answers = asked.join(counted, "pair").groupBy("chunk").agg(F.collect_list(F.struct("at", "value")).alias("answers"))

    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(iterator):
            for i in range(batch.num_rows):
                row = {name: batch.column(k).slice(i, 1) for k, name in enumerate(batch.schema.names)}
                rows = row["documents"].flatten()
                doc_id, n_a, n_b, n_groups, sha = rows.flatten()
                n = n_groups.to_numpy()
                links = _unpacked(row["links"][0].as_py(), int(n.sum()))
                found = row["answers"].flatten()
                values = np.zeros(len(found), np.int64)
                if len(found):
                    at, value = (x.to_numpy() for x in found.flatten())
                    values[at] = value
                best, total = [], []
                for low, high in zip((np.cumsum(n) - n).tolist(), np.cumsum(n).tolist(), strict=True):
                    own = values[links[low:high]]
                    best.append(int((own & 1).sum()))
                    total.append(int((own >> 1).sum()))
                yield pa.RecordBatch.from_arrays(
                    [doc_id, n_a, n_b, n_groups, n_groups, pa.array(best, pa.int64()), pa.array(total, pa.int64()), sha],
                    [c.split()[0] for c in RESULT.split(", ")],
                )

    joined = chunks.select("chunk", "documents", "links").join(answers.hint("merge"), "chunk", "left")
    return joined.select("documents", "links", "answers").mapInArrow(run, RESULT)
