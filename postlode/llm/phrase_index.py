"""Positional inverted index of a training corpus, and phrase and proximity search over it.

The index is cut into segments, each of some documents. A segment holds a row per token with the token's
positions in it, and a row with its documents' ids and lengths. Positions count through a segment,
with a gap after each document, so that no match crosses documents and a segment needs one number
per posting. Postings are stored as deltas. Segments are bounded by their token count, whatever the
frequency of a token is, so a hot word is as many short lists as there are segments.

A search reads the rows of the terms asked for, groups them by segment, and intersects, for each
window, the offset-adjusted lists from the segment's rarest term on. Windows are the stated query
set; they go to the segments in blocks of about ``WINDOWS_PER_BLOCK``, one at a time.

Edge cases: a null or empty text has no words and a zero count. Rows are kept apart by their place in
the index, so repeated ids give a result row each. Null ids are kept. An item without words gives
no window; null item ids are left out. Equal items are all reported.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlode.llm.shared import batches, byte_texts, discard, lean, stored, texts_of

WINDOW_WORDS = 10
# A segment ends after so many tokens, or with its partition.
SEGMENT_TOKENS = 2_000_000
# Positions left out after a document; more than any window or proximity span.
GAP = 64
WINDOWS_PER_BLOCK = 200_000
_SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
# A-Z to a-z first, then every separator to a blank: one pass over the bytes.
_TABLE = bytes(
    0x20 if b in _SEPARATORS else b for b in (x + 32 if 0x41 <= x <= 0x5A else x for x in range(256))
)
INDEX = "segment string, token binary, df int, postings binary, ids binary, lengths binary"
INDEX_SCHEMA = pa.schema(
    [("segment", pa.string()), ("token", pa.binary()), ("df", pa.int32()), ("postings", pa.binary()),
     ("ids", pa.binary()), ("lengths", pa.binary())]
)
NULL_ID = np.iinfo(np.int64).min


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased runs of a-z, 0-9 and everything outside ASCII."""
    return text.translate(_TABLE).split()


class _Words:
    """The words of a segment, out of Python's objects but for the last few."""

    def __init__(self):
        self._parts: list[pa.Array] = []
        self._last: list[bytes] = []
        self._n = 0

    def add(self, words: list[bytes]) -> None:
        self._last += words
        self._n += len(words)
        if len(self._last) >= 50_000:
            self._pass_on()

    def _pass_on(self) -> None:
        self._parts.append(pa.array(self._last, pa.binary()))
        self._last = []

    def coded(self) -> pa.DictionaryArray:
        self._pass_on()
        coded = pa.chunked_array(self._parts).dictionary_encode()
        self._parts = []
        return coded.combine_chunks()

    def __len__(self) -> int:
        return self._n


def _segment(name: str, ids: list[int], lengths: list[int], tokens: _Words) -> Iterator[pa.RecordBatch]:
    """Index rows of one segment; ``tokens``, used up here, runs through all its documents."""
    sizes = np.array(lengths, np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + GAP)[:-1]]) if len(sizes) else np.empty(0, np.int64)
    head = (np.array(ids, np.int64).tobytes(), sizes.astype(np.int32).tobytes())
    yield pa.RecordBatch.from_arrays(
        [pa.array([name]), pa.array([None], pa.binary()), pa.array([len(ids)], pa.int32()),
         pa.array([None], pa.binary()), pa.array([head[0]], pa.binary()), pa.array([head[1]], pa.binary())],
        schema=INDEX_SCHEMA,
    )
    if not tokens:
        return
    coded = tokens.coded()
    codes = coded.indices.to_numpy()
    positions = np.repeat((np.arange(len(sizes)) * GAP).astype(np.uint32), sizes)
    positions += np.arange(len(tokens), dtype=np.uint32)
    positions = positions[np.argsort(codes, kind="stable")]
    counts = np.bincount(codes, minlength=len(coded.dictionary))
    ends = np.cumsum(counts)
    deltas = np.diff(positions, prepend=np.uint32(0)).astype(np.uint32)
    firsts = ends - counts
    deltas[firsts] = positions[firsts]
    offsets = np.concatenate([[0], ends]) * 4
    for low in range(0, len(counts), 50_000):
        high = min(low + 50_000, len(counts))
        cut = offsets[low : high + 1]
        if cut[-1] - cut[0] >= 2**31 - 1:
            raise ValueError("a segment holds more postings than one batch can carry")
        postings = pa.Array.from_buffers(
            pa.binary(), high - low,
            [None, pa.py_buffer((cut - cut[0]).astype(np.int32)), pa.py_buffer(deltas[cut[0] // 4 : cut[-1] // 4])],
        )
        nulls = pa.nulls(high - low, pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * (high - low)), coded.dictionary.slice(low, high - low),
             pa.array(counts[low:high], pa.int32()), postings, nulls, nulls],
            schema=INDEX_SCHEMA,
        )


def build_index(documents: DataFrame, segment_tokens: int = SEGMENT_TOKENS) -> DataFrame:
    """The stored positional index of all texts."""

    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        ids: list[int] = []
        lengths: list[int] = []
        tokens = _Words()
        for batch in batches(iterator):
            for doc, text in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1)), strict=True):
                words = words_of(text)
                ids.append(NULL_ID if doc is None else doc)
                lengths.append(len(words))
                tokens.add(words)
                if len(tokens) >= segment_tokens or len(ids) >= segment_tokens:
                    yield from _segment(f"{part}-{number}", ids, lengths, tokens)
                    number, ids, lengths, tokens = number + 1, [], [], _Words()
        if ids:
            yield from _segment(f"{part}-{number}", ids, lengths, tokens)

    return stored(texts_of(documents).mapInArrow(lean(run), INDEX), "phrase-index")


def windows_of(items: DataFrame, window_words: int = WINDOW_WORDS) -> DataFrame:
    """``item_id, terms`` of every run of ``window_words`` words, or of a shorter item's whole words."""

    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(iterator):
            found = []
            for item, text in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1)), strict=True):
                words = words_of(text)
                if words and item is not None:
                    last = max(1, len(words) - window_words + 1)
                    found += [(item, words[i : i + window_words]) for i in range(last)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.list_(pa.binary()))],
                ["item_id", "terms"],
            )

    source = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    return source.mapInArrow(lean(run), "item_id long, terms array<binary>")


class Segment:
    """Postings of one segment, for the terms of the search alone."""

    def __init__(self, ids: bytes, lengths: bytes, postings: dict[bytes, bytes]):
        self.ids = np.frombuffer(ids, np.int64)
        self.lengths = np.frombuffer(lengths, np.int32).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths + GAP)[:-1]])
        self._packed = postings
        self._lists: dict[bytes, np.ndarray] = {}

    def positions(self, token: bytes) -> np.ndarray:
        if token not in self._lists:
            self._lists[token] = np.cumsum(np.frombuffer(self._packed[token], np.uint32), dtype=np.int64)
        return self._lists[token]

    def _rarest_first(self, terms: list[bytes]) -> list[int] | None:
        if any(t not in self._packed for t in terms):
            return None
        return sorted(range(len(terms)), key=lambda i: len(self._packed[terms[i]]))

    def phrase(self, terms: list[bytes]) -> np.ndarray:
        """Start positions of the exact phrase."""
        order = self._rarest_first(terms)
        if order is None:
            return np.empty(0, np.int64)
        starts = self.positions(terms[order[0]]) - order[0]
        for i in order[1:]:
            if not len(starts):
                break
            there = self.positions(terms[i])
            at = np.searchsorted(there, starts + i)
            at[at == len(there)] = 0
            starts = starts[there[at] == starts + i]
        return starts

    def proximity(self, terms: list[bytes], span: int) -> np.ndarray:
        """Positions of the rarest term that have every other term within ``span`` words of them."""
        order = self._rarest_first(terms)
        if order is None or span >= GAP:
            if span >= GAP:
                raise ValueError(f"a span must be below {GAP}")
            return np.empty(0, np.int64)
        near = self.positions(terms[order[0]])
        for i in order[1:]:
            there = self.positions(terms[i])
            low = np.searchsorted(there, near - span)
            high = np.searchsorted(there, near + span, side="right")
            near = near[high > low]
        return near

    def ids_of(self, docs: np.ndarray) -> pa.Array:
        return pa.array([None if x == NULL_ID else x for x in self.ids[docs].tolist()], pa.int64())

    def document_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, positions, side="right") - 1


def _segments(index: DataFrame, windows: DataFrame) -> DataFrame:
    """A row per segment with its head and the postings of the terms that any window holds."""
    terms = windows.select(F.explode("terms").alias("token")).distinct()
    listed = index.where("token is not null").join(terms, "token", "left_semi")
    heads = index.where("token is null").select("segment", "ids", "lengths")
    gathered = listed.groupBy("segment").agg(F.collect_list(F.struct("token", "postings")).alias("lists"))
    return heads.join(gathered, "segment", "left")


def _open(row: dict) -> Segment:
    return Segment(row["ids"], row["lengths"], {x["token"]: x["postings"] for x in row["lists"] or []})


def _per_block(segments: DataFrame, windows: DataFrame, search: Callable, schema: str, name: str) -> DataFrame:
    """What ``search`` finds in every segment for every block of the distinct windows.

    ``search`` takes an open segment's row and a block, windows with their items, and yields batches. Windows are
    dealt to blocks by hash, a row at a time, so a window that very many items share is spread over blocks too. The
    driver holds one block; its matches are written before the next is read, and its broadcast is then gone.
    """
    context = segments.sparkSession.sparkContext
    distinct = stored(windows.select("terms", "item_id").distinct(), "distinct-windows")
    n_blocks = max(1, -(-distinct.count() // WINDOWS_PER_BLOCK))
    number = F.pmod(F.xxhash64("terms", "item_id"), F.lit(n_blocks))
    # In the order of blocks, so that a block's rows are read from its own files.
    dealt = stored(distinct.withColumn("block", number).sort("block"), "window-blocks")
    found = []
    for i in range(n_blocks):
        block: dict[tuple[bytes, ...], list[int]] = defaultdict(list)
        for row in dealt.where(F.col("block") == i).collect():
            block[tuple(bytes(t) for t in row.terms)].append(row.item_id)
        shared = context.broadcast(dict(block))

        def run(iterator: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches(iterator):
                for row in batch.to_pylist():
                    yield from search(row["segment"], _open(row), shared.value)

        found.append(stored(segments.mapInArrow(lean(run), schema), name))
        shared.destroy()
    for used in (segments, distinct, dealt):
        discard(used)
    return reduce(DataFrame.unionByName, found)


def _candidates(segment: Segment, windows: dict[tuple[bytes, ...], list[int]]) -> Iterator[tuple]:
    for terms, items in windows.items():
        starts = segment.phrase(list(terms))
        if len(starts):
            yield terms, items, starts


def phrase_matches(index: DataFrame, windows: DataFrame) -> DataFrame:
    """``segment, doc, doc_id, item_id, pos, n_words`` of every exact occurrence of a window.

    ``doc`` is the document's number in its segment, which tells repeated ids apart.
    """

    def search(name: str, segment: Segment, block: dict) -> Iterator[pa.RecordBatch]:
        for terms, items, starts in _candidates(segment, block):
            docs = segment.document_of(starts)
            n = len(starts)
            for item in items:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * n), pa.array(docs, pa.int32()), segment.ids_of(docs),
                     pa.array([item] * n, pa.int64()), pa.array(starts - segment.starts[docs], pa.int32()),
                     pa.array([len(terms)] * n, pa.int32())],
                    ["segment", "doc", "doc_id", "item_id", "pos", "n_words"],
                )

    schema = "segment string, doc int, doc_id long, item_id long, pos int, n_words int"
    return _per_block(stored(_segments(index, windows), "phrase-lists"), windows, search, schema, "phrase-matches")


def proximity_matches(index: DataFrame, queries: DataFrame, span: int) -> DataFrame:
    """``doc_id, item_id, pos``: where all of a query's terms stand within ``span`` words of its rarest one."""

    def search(name: str, segment: Segment, block: dict) -> Iterator[pa.RecordBatch]:
        for terms, items in block.items():
            near = segment.proximity(list(dict.fromkeys(terms)), span)
            docs = segment.document_of(near)
            for item in items if len(near) else []:
                yield pa.RecordBatch.from_arrays(
                    [segment.ids_of(docs), pa.array([item] * len(near), pa.int64()),
                     pa.array(near - segment.starts[docs], pa.int32())],
                    ["doc_id", "item_id", "pos"],
                )

    lists = stored(_segments(index, queries), "proximity-lists")
    return _per_block(lists, queries, search, "doc_id long, item_id long, pos int", "proximity-matches")


def _runs(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The union of some spans as disjoint ``[start, end)`` rows in order."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    first = np.ones(len(starts), bool)
    first[1:] = starts[1:] > reach[:-1]
    return np.stack([starts[first], reach[np.append(np.flatnonzero(first)[1:], len(starts)) - 1]], axis=1)


SUMMARY = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def items_digest(items: list[int]) -> str:
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


def _hits(name: str, segment: Segment, block: dict) -> Iterator[pa.RecordBatch]:
    """A row per document with a hit: the runs of its hit words and the items they are from."""
    found: dict[int, set[int]] = defaultdict(set)
    all_starts, all_ends = [], []
    for terms, items, starts in _candidates(segment, block):
        all_starts.append(starts)
        all_ends.append(starts + len(terms))
        for doc in np.unique(segment.document_of(starts)).tolist():
            found[doc].update(items)
    if not found:
        return
    runs = _runs(np.concatenate(all_starts), np.concatenate(all_ends))
    of = segment.document_of(runs[:, 0])  # in order, as the runs are; none crosses documents
    docs = np.unique(of)
    edges = np.searchsorted(of, docs, side="left").tolist() + [len(of)]
    yield pa.RecordBatch.from_arrays(
        [pa.array([name] * len(docs)), pa.array(docs, pa.int32()),
         pa.array([runs[low:high].tobytes() for low, high in pairwise(edges)], pa.binary()),
         pa.array([list(found[doc]) for doc in docs.tolist()], pa.list_(pa.int64()))],
        ["segment", "doc", "runs", "items"],
    )


def contamination(documents: DataFrame, items: DataFrame, window_words: int = WINDOW_WORDS) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every row.

    A segment merges the hits of each of its documents for a block of windows, so a document with very many
    occurrences gives one row a block; the rows of all blocks meet per document.
    """
    windows = stored(windows_of(items, window_words), "windows")
    index = build_index(documents)
    hits = _per_block(
        stored(_segments(index, windows), "phrase-lists"), windows, _hits,
        "segment string, doc int, runs binary, items array<long>", "phrase-hits",
    )
    discard(windows)
    matches = hits.groupBy("segment", "doc").agg(
        F.collect_list("runs").alias("runs"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")
    )

    def heads(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(iterator):
            for row in batch.to_pylist():
                segment = Segment(row["ids"], row["lengths"], {})
                n = len(segment.ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["segment"]] * n), pa.array(np.arange(n), pa.int32()),
                     segment.ids_of(np.arange(n)), pa.array(segment.lengths)],
                    ["segment", "doc", "doc_id", "n_words"],
                )

    none = items_digest([])

    def merge(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(iterator):
            n_hit = []
            for blocks in batch.column("runs").to_pylist():
                spans = np.frombuffer(b"".join(blocks or []), np.int64).reshape(-1, 2)
                n_hit.append(int(np.diff(_runs(spans[:, 0], spans[:, 1])).sum()) if len(spans) else 0)
            found = batch.column("items").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_words"), pa.array(n_hit, pa.int64()),
                 pa.array([len(x or []) for x in found], pa.int64()),
                 pa.array([items_digest(x) if x else none for x in found], pa.string()),
                 pa.array([n > 0 for n in n_hit])],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    rows = index.where("token is null").select("segment", "ids", "lengths").mapInArrow(
        lean(heads), "segment string, doc int, doc_id long, n_words long"
    )
    return rows.join(matches, ["segment", "doc"], "left").mapInArrow(lean(merge), SUMMARY)


def clean_documents(documents: DataFrame, items: DataFrame, window_words: int = WINDOW_WORDS) -> DataFrame:
    """The rows without an occurrence of a benchmark window, with all their columns.

    Rows are told apart by a hash of id and text, so a clean text stays when its id is also a contaminated one's, and
    null ids need no other way. Equal rows stay or go together. A null or empty text has no
    words and stays; without benchmark words all rows stay.
    """
    def own(df: DataFrame):
        return F.xxhash64(df["doc_id"].cast("long"), df["text"])

    keyed = documents.select(own(documents).alias("doc_id"), "text")
    spoilt = contamination(keyed, items, window_words).where("contaminated").select(F.col("doc_id").alias("_spoilt"))
    spoilt = stored(spoilt.distinct(), "contaminated")
    return documents.join(spoilt, own(documents) == spoilt["_spoilt"], "left_anti")
