"""Removal of repeated byte strings by suffix arrays of shards.

A byte goes if a string of ``MATCH`` bytes that covers it also starts in a document with a smaller id.

1. Texts are put together to groups of about ``GROUP_BYTES``, stored once.
2. Each window of ``MATCH`` bytes has a smallest hash among its ``GRAM``-byte grams, which depends on the
   window's bytes alone. Windows in a row with the same smallest hash form a run. The hashes say which shard decides a
   window; hashes that only one document has cannot hold a match and are dropped before any text moves.
3. The strings of the runs left go to their shards, equal ones of a group once, with their smallest document.
4. A string that is the only one with its hash matches no other. A shard sorts the suffixes of its other distinct strings
   by induced sorting, about ``SORTED`` symbols at a time; strings of one hash are sorted together. Permuted common
   prefixes of ``MATCH`` bytes or more join neighbours to classes, and a class's smallest document goes to all its starts.
5. The groups remove what is covered by windows whose class has a smaller document than their own.

A string that a third of the documents share is one entry per group in its shard. Shards are as many as
the input's bytes ask for, so none outgrows a task. Between groups and shards goes a row for each pair, so both are
large; a group's runs are taken in all shards at once, in the order of their hashes.

Edge cases: a null or empty text has no bytes and loses none. Rows that share a doc_id are one document, which does not
repeat itself. Null ids count as larger than all others and lose nothing to each other. Texts shorter than ``MATCH``
stay whole. Matches do not cross documents. Strings are judged on the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlode.llm.induced_sort import permuted_prefixes, suffix_array
from postlode.llm.shared import batches, byte_texts, stored, texts_of

MATCH = 50
GRAM = 16
GROUP_BYTES = 8 << 20
SLICE = 1 << 20
# Of compressed text before any is dropped; what reaches a shard is a fraction of it.
SHARD_BYTES = 5 << 20
SORTED = 1 << 20
NULL_ID = np.iinfo(np.int64).max
_MULTIPLIER = 0x9E3779B97F4A7C15
GROUP = "grp long, ids binary, sizes binary, nulls binary, body binary"
NAMES = ["grp", "ids", "sizes", "nulls", "body"]


def _planes(values: np.ndarray) -> bytes:
    """The first bytes of all numbers, then the second bytes and so on, which compress better."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _numbers(data: bytes, kind: type, count: int, at: int = 0) -> np.ndarray:
    """``count`` numbers that ``_planes`` made bytes, from byte ``at`` on."""
    size = np.dtype(kind).itemsize
    plain = np.frombuffer(data, np.uint8, size * count, at).reshape(size, count)
    return np.ascontiguousarray(plain.T).view(kind).reshape(count)


def _grouped(documents: DataFrame) -> DataFrame:
    """Rows of documents put together: ids, sizes, and all texts in a row, compressed."""

    def pack(number: int, ids: list[int | None], texts: list[bytes]) -> pa.RecordBatch:
        plain = np.array([NULL_ID if i is None else i for i in ids], np.int64)
        body = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
        columns = [
            pa.array([number]), pa.array([plain.tobytes()], pa.binary()),
            pa.array([np.array([len(t) for t in texts], np.int64).tobytes()], pa.binary()),
            pa.array([np.packbits([i is None for i in ids]).tobytes()], pa.binary()), pa.array([body], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, NAMES)

    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        ids, texts, size = [], [], 0
        for batch in batches(iterator):
            for doc_id, text in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1)), strict=True):
                ids.append(doc_id)
                texts.append(text)
                size += len(text) + 16
                if size >= GROUP_BYTES:
                    yield pack(number, ids, texts)
                    number, ids, texts, size = number + 1, [], [], 0
        if ids:
            yield pack(number, ids, texts)

    return texts_of(documents).mapInArrow(run, GROUP)


class Group:
    """A group's documents, opened."""

    def __init__(self, row: dict):
        self.number = row["grp"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.sizes = np.frombuffer(row["sizes"], np.int64)
        self.nulls = np.unpackbits(np.frombuffer(row["nulls"], np.uint8))[: len(self.ids)].astype(bool)
        self.text = zstandard.ZstdDecompressor().decompress(row["body"], max_output_size=max(1, int(self.sizes.sum())))
        self.ends = np.cumsum(self.sizes)

    def runs(self, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``code, start, count, doc`` of every run of windows; a code is a shard and 32 bits of the hash."""
        codes, starts, counts = [], [], []
        data = np.frombuffer(self.text, np.uint8)
        for low in range(0, max(0, len(data) - MATCH + 1), SLICE):
            high = min(low + SLICE, len(data) - MATCH + 1)
            smallest = window_hashes(data[low : high + MATCH - 1])
            edge = np.append(True, smallest[1:] != smallest[:-1])
            # A document's start begins a run, and windows that cross its end are left out.
            inner = self.ends[(self.ends > low) & (self.ends < high)] - low
            edge[inner] = True
            at = np.flatnonzero(edge)
            begin = at + low
            doc = np.searchsorted(self.ends, begin, side="right")
            length = np.minimum(np.append(at[1:], len(smallest)) + low, self.ends[doc] - MATCH + 1) - begin
            value = smallest[at]
            whole = length > 0
            value, begin, length = value[whole], begin[whole], length[whole]
            codes.append(((value >> np.uint64(32)) % np.uint64(shards) << np.uint64(32)) | (value & np.uint64(0xFFFFFFFF)))
            starts.append(begin)
            counts.append(length)
        if not codes:
            none = np.empty(0, np.int64)
            return none.astype(np.uint64), none, none, none
        start = np.concatenate(starts)
        return np.concatenate(codes), start, np.concatenate(counts), np.searchsorted(self.ends, start, side="right")


def window_hashes(data: np.ndarray) -> np.ndarray:
    """For each window of ``MATCH`` bytes, the smallest mixed hash of its grams."""
    with np.errstate(over="ignore"):
        h = data.astype(np.uint64) + np.uint64(1)
        width = 1
        while width < GRAM:
            h = h[:-width] * np.uint64(pow(_MULTIPLIER, width, 1 << 64)) + h[width:]
            width *= 2
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    span, width = MATCH - GRAM + 1, 1
    while 2 * width <= span:
        h = np.minimum(h[:-width], h[width:])
        width *= 2
    return np.minimum(h[: len(h) - (span - width)], h[span - width :]) if span > width else h


def _hash_rows(shards: int):
    """For each group and shard, the distinct codes and whether several documents of the group have them."""

    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(iterator):
            for row in batch.to_pylist():
                group = Group(row)
                codes, _, _, doc = group.runs(shards)
                unique, where = np.unique(codes, return_inverse=True)
                least = np.full(len(unique), NULL_ID)
                most = np.full(len(unique), np.iinfo(np.int64).min)
                np.minimum.at(least, where, group.ids[doc])
                np.maximum.at(most, where, group.ids[doc])
                several = least != most
                shard = (unique >> np.uint64(32)).astype(np.int64)
                there, cuts = np.unique(shard, return_index=True)
                keys = unique.astype(np.uint32)
                steps = np.diff(keys, prepend=np.uint32(0))
                steps[cuts] = keys[cuts]
                ends = [*cuts.tolist(), len(keys)]
                pieces = list(zip(ends[:-1], ends[1:], strict=True))
                if pieces:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(there, pa.int32()), pa.array([group.number] * len(there)),
                         pa.array([_planes(steps[a:b]) for a, b in pieces], pa.binary()),
                         pa.array([np.packbits(several[a:b]).tobytes() for a, b in pieces], pa.binary())],
                        ["shard", "grp", "keys", "several"],
                    )

    return run


def _shared_codes(table: pa.Table) -> pa.Table:
    """Which codes of each group are in several documents, in one shard."""
    rows = table.to_pylist()
    lists = [np.cumsum(_numbers(r["keys"], np.uint32, len(r["keys"]) // 4), dtype=np.uint32) for r in rows]
    marks = [np.unpackbits(np.frombuffer(r["several"], np.uint8))[: len(k)] for r, k in zip(rows, lists, strict=True)]
    _, where, times = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    shared = times > 1
    shared[where[np.concatenate(marks) == 1]] = True
    found = np.split(shared[where], np.cumsum([len(k) for k in lists])[:-1])
    return pa.table(
        {"grp": pa.array([r["grp"] for r in rows]), "shard": pa.array([r["shard"] for r in rows], pa.int32()),
         "shared": pa.array([np.packbits(f).tobytes() for f in found], pa.binary())}
    )


CANDIDATES = "grp long, shard int, numbers binary, body binary"


def _candidates(shards: int):
    """Strings of runs with shared codes, by shard, and, with a number below zero, where the group's runs are.

    A group's strings are in the order of their codes, and with that of their shards.
    """

    def rows_of(group: Group, listed: list[dict]) -> list[tuple]:
        codes, start, count, doc = group.runs(shards)
        unique, where = np.unique(codes, return_inverse=True)
        _, sizes = np.unique(unique >> np.uint64(32), return_counts=True)
        bits = [np.frombuffer(item["shared"], np.uint8) for item in sorted(listed, key=lambda item: item["shard"])]
        shared = np.concatenate([np.unpackbits(b, count=n) for b, n in zip(bits, sizes.tolist(), strict=True)])
        kept = np.flatnonzero(shared[where])
        if not len(kept):
            return []
        start, count, doc = start[kept], count[kept], doc[kept]
        strings: dict[bytes, int] = {}
        text = group.text
        number = [
            strings.setdefault(text[a:b], len(strings))
            for a, b in zip(start.tolist(), (start + count + MATCH - 1).tolist(), strict=True)
        ]
        number = np.array(number, np.int64)
        least = np.full(len(strings), NULL_ID)
        np.minimum.at(least, number, group.ids[doc])
        code = np.empty(len(strings), np.uint64)
        code[number] = codes[kept]
        bodies = list(strings)
        strings.clear()
        order = np.argsort(code, kind="stable")
        code, least = code[order], least[order]
        bodies = [bodies[i] for i in order.tolist()]
        length = np.fromiter(map(len, bodies), np.int32, len(bodies))
        there, cuts = np.unique(code >> np.uint64(32), return_index=True)
        # Three bytes tell apart nearly all codes of a shard.
        key = (code & np.uint64(0xFFFFFFFF)).astype(np.uint32) >> np.uint32(8)
        steps = np.diff(key, prepend=np.uint32(0))
        steps[cuts] = key[cuts]
        packer = zstandard.ZstdCompressor(level=1)
        out = []
        for k, a, b in zip(there.tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(bodies)], strict=True):
            numbers = _planes(length[a:b]) + _planes(steps[a:b]) + _planes(least[a:b])
            out.append((group.number, k, packer.compress(numbers), packer.compress(b"".join(bodies[a:b]))))
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        kept_at = -1 - (group.number ^ group.number >> 33) % shards
        members = _planes(np.diff(start, prepend=0)) + _planes(place[number])
        out.append((group.number, kept_at, b"", packer.compress(members)))
        return out

    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        for batch in batches(iterator):
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                found = rows_of(Group(row), row["listed"]) if row["listed"] else []
                if found:
                    columns = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["grp", "shard", "numbers", "body"]
                    )

    return run


def _sorted_runs(bodies: list[bytes], length: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For strings and their smallest documents, runs of starts with the smallest document that has the 50 bytes there.

    Returns the number of runs of each string, and ``lengths, values`` of all runs.
    """
    # One symbol more than bytes have: zero ends each string.
    symbols = np.frombuffer(b"\0".join([*bodies, b""]), np.uint8).astype(np.uint16)
    symbols += np.uint16(1)
    ends = np.cumsum(length + 1)
    symbols[ends - 1] = 0
    most = int(symbols.max())
    symbols = symbols.astype(np.uint8 if most < 1 << 8 else np.uint16, copy=False)
    sa = suffix_array(symbols, most + 1, MATCH)
    plcp = permuted_prefixes(symbols, sa, MATCH)
    first = plcp[sa] < MATCH
    del plcp, symbols
    of = np.repeat(np.arange(len(length), dtype=np.int32), length + 1)
    first[0] = True
    heads = np.flatnonzero(first)
    smallest = np.empty(len(sa), np.int64)
    # A start with fewer bytes left has a class of its own.
    smallest[sa] = np.repeat(np.minimum.reduceat(least[of[sa]], heads), np.diff(np.append(heads, len(sa))))
    del sa, first
    # Windows of a string in a row with the same document become one run.
    windows = length - MATCH + 1
    begin = ends - length - 1
    at = np.arange(int(windows.sum())) + np.repeat(begin - (np.cumsum(windows) - windows), windows)
    values = smallest[at]
    edge = np.append(True, values[1:] != values[:-1])
    edge[np.cumsum(windows)[:-1]] = True
    heads = np.flatnonzero(edge)
    return np.bincount(of[at[heads]], minlength=len(length)), np.diff(np.append(heads, len(edge))), values[heads]


def _decide_shard(table: pa.Table) -> pa.Table:
    """For each group's strings, runs of starts with the smallest document that has the 50 bytes there."""
    if table.column("shard")[0].as_py() < 0:  # not strings but places, which wait for the results
        return table.select(["grp", "shard", "body"])
    strings: dict[bytes, int] = {}
    number, keys, docs, sizes = [], [], [], []
    opener = zstandard.ZstdDecompressor()
    for packed, body in zip(table.column("numbers"), table.column("body"), strict=True):
        numbers = opener.decompress(packed.as_py())
        n = len(numbers) // 16
        ends = np.cumsum(_numbers(numbers, np.int32, n)).tolist()
        keys.append(np.cumsum(_numbers(numbers, np.uint32, n, 4 * n), dtype=np.uint32))
        docs.append(_numbers(numbers, np.int64, n, 8 * n))
        text = opener.decompress(body.as_py())
        number.append(np.array(
            [strings.setdefault(text[a:b], len(strings)) for a, b in zip([0, *ends[:-1]], ends, strict=True)], np.int32))
        sizes.append(n)
    number = np.concatenate(number)
    least = np.full(len(strings), NULL_ID)
    np.minimum.at(least, number, np.concatenate(docs))
    key = np.empty(len(strings), np.uint32)
    key[number] = np.concatenate(keys)
    del keys, docs
    bodies = list(strings)
    strings.clear()
    length = np.fromiter(map(len, bodies), np.int64, len(bodies))
    # Equal windows have equal keys, so a string that is alone with its key has one class for each window.
    order = np.argsort(key, kind="stable")
    heads = np.flatnonzero(np.append(True, key[order[1:]] != key[order[:-1]]))
    times = np.diff(np.append(heads, len(order)))
    alone = np.repeat(times == 1, times)
    single, order = order[alone], order[~alone]
    runs, lengths, values = [np.ones(len(single), np.int64)], [length[single] - MATCH + 1], [least[single]]
    # The others are sorted in parts that no key crosses.
    heads = np.cumsum(times[times > 1]) - times[times > 1]
    done = (np.cumsum(length[order] + 1) - length[order] - 1)[heads] // SORTED
    cuts = heads[np.append(True, done[1:] != done[:-1])] if len(heads) else heads
    for part in np.split(order, cuts[1:]) if len(order) else ():
        found = _sorted_runs([bodies[i] for i in part.tolist()], length[part], least[part])
        for all_, some in zip((runs, lengths, values), found, strict=True):
            all_.append(some)
    order = np.concatenate([single, order])
    runs, lengths, values = np.concatenate(runs), np.concatenate(lengths), np.concatenate(values)
    runs_of, first_of = np.empty_like(runs), np.empty_like(runs)
    runs_of[order] = runs
    first_of[order] = np.cumsum(runs) - runs
    packer = zstandard.ZstdCompressor(level=1)
    blobs, done = [], 0
    for n in sizes:
        own = number[done : done + n]
        done += n
        runs = runs_of[own]
        at = np.arange(int(runs.sum())) + np.repeat(first_of[own] - (np.cumsum(runs) - runs), runs)
        parts = [_planes(runs.astype(np.int32)), _planes(lengths[at].astype(np.int32)), _planes(values[at])]
        blobs.append(packer.compress(b"".join([np.int64(n).tobytes(), *parts])))
    return pa.table({"grp": table.column("grp"), "shard": table.column("shard"), "body": pa.array(blobs, pa.binary())})


def _spans(group: Group, listed: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends, in the group's text, of the windows' cover; merged and in order."""
    none = np.empty(0, np.int64)
    if not listed:
        return none, none
    opener = zstandard.ZstdDecompressor()
    # The places come first: their number is below zero. The strings' results are in the order of the places.
    bodies = [opener.decompress(item["body"]) for item in sorted(listed, key=lambda item: item["shard"])]
    count = len(bodies[0]) // 12
    start, place = np.cumsum(_numbers(bodies[0], np.int64, count)), _numbers(bodies[0], np.int32, count, 8 * count)
    runs, lengths, docs = [], [], []
    for body in bodies[1:]:
        n = int(np.frombuffer(body, np.int64, 1)[0])
        total = (len(body) - 8 - 4 * n) // 12
        runs.append(_numbers(body, np.int32, n, 8))
        lengths.append(_numbers(body, np.int32, total, 8 + 4 * n))
        docs.append(_numbers(body, np.int64, total, 8 + 4 * n + 4 * total))
    runs, lengths, docs = np.concatenate(runs).astype(np.int64), np.concatenate(lengths).astype(np.int64), np.concatenate(docs)
    first = np.cumsum(runs) - runs
    offset = np.cumsum(lengths) - lengths
    offset = offset - np.repeat(offset[first], runs)  # within the string
    n = runs[place]
    at = np.repeat(first[place] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    low = np.repeat(start, n) + offset[at]
    own = group.ids[np.searchsorted(group.ends, start, side="right")]
    covered = docs[at] < np.repeat(own, n)
    start = low[covered]
    end = start + lengths[at[covered]] + MATCH - 1
    if not len(start):
        return none, none
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    # Neighbouring documents are cut apart again below; within one, cover that touches is one span.
    new = np.append(True, start[1:] > end[:-1])
    cut = np.append(False, np.searchsorted(group.ends, start[1:], side="right") != np.searchsorted(group.ends, start[:-1], side="right"))
    heads = np.flatnonzero(new | cut)
    return start[heads], np.maximum.reduceat(end, heads)


def _results(documents: DataFrame) -> DataFrame:
    """Stored groups with what was found for them: ``grp, ..., listed``."""
    groups = stored(_grouped(documents), "text-groups")
    total = groups.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0))).first()[0]
    width = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(width, total // SHARD_BYTES)
    hashes = groups.mapInArrow(_hash_rows(shards), "shard int, grp long, keys binary, several binary")
    shared = hashes.groupBy("shard").applyInArrow(_shared_codes, "grp long, shard int, shared binary")
    by_group = shared.groupBy("grp").agg(F.collect_list(F.struct("shard", "shared")).alias("listed"))
    marked = groups.join(by_group.hint("merge"), "grp")
    candidates = marked.mapInArrow(_candidates(shards), CANDIDATES)
    decided = candidates.groupBy("shard").applyInArrow(_decide_shard, "grp long, shard int, body binary")
    lists = decided.groupBy("grp").agg(F.collect_list(F.struct("shard", "body")).alias("listed"))
    return groups.join(lists.hint("merge"), "grp", "left")


def _map_documents(documents: DataFrame, make, schema: str) -> DataFrame:
    """Apply ``make(doc_id, text, spans)`` to every document; spans are removed ranges of its bytes."""
    kinds = {"long": pa.int64(), "string": pa.string()}
    fields = [x.split() for x in schema.split(", ")]

    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(iterator):
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                group = Group(row)
                start, end = _spans(group, row["listed"] or [])
                doc = np.searchsorted(group.ends, start, side="right")
                cuts = np.searchsorted(doc, np.arange(len(group.ids) + 1)).tolist()
                rows, low = [], 0
                for k, high in enumerate(group.ends.tolist()):
                    spans = [(a - low, b - low) for a, b in zip(
                        start[cuts[k] : cuts[k + 1]].tolist(), end[cuts[k] : cuts[k + 1]].tolist(), strict=True)]
                    rows.append(make(None if group.nulls[k] else int(group.ids[k]), group.text[low:high], spans))
                    low = high
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], [f[0] for f in fields]
                )

    return _results(documents).mapInArrow(run, schema)


def kept_bytes(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, low = [], 0
    for start, end in spans:
        parts.append(text[low:start])
        low = end
    return b"".join([*parts, text[low:]])


def digests(documents: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row."""

    def make(doc_id: int | None, text: bytes, spans: list[tuple[int, int]]) -> tuple:
        kept = kept_bytes(text, spans)
        return doc_id, len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()

    return _map_documents(documents, make, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(documents: DataFrame) -> DataFrame:
    """``doc_id, text`` with the repeated bytes gone; what no longer is UTF-8 at a cut is replaced."""

    def make(doc_id: int | None, text: bytes, spans: list[tuple[int, int]]) -> tuple:
        return doc_id, kept_bytes(text, spans).decode("utf-8", "replace")

    return _map_documents(documents, make, "doc_id long, text string")
