"""Order-preserving packing by dynamic programming.

Documents follow each other by doc_id, as one run of tokens. Windows of at most ``size`` tokens are cut from it
at document ends, sentence ends or, inside long sentences, every ``HARD_STEP`` tokens. The cuts minimise
padding plus a penalty for each cut that splits a document. With ``cost[j] = penalty[j] + size - end[j] + min(cost[i] +
end[i])`` over the cuts ``i`` within a window, the minimum slides, so a monotone queue finds it in
constant time and a partition is packed in linear time.

A partition is a range of ids. It is packed on its own, in segments of ``SEGMENT_CUTS`` cuts that end with a
document, so memory is bounded; a segment's last window may be short.

Edge cases: null and empty texts are a document of the end id alone. Rows that share a doc_id are documents
of their own, in the order of their texts. Null ids come first. An empty table has no sequences.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlode.llm.shared import batches, lean, texts_of
from postlode.llm.tokens import encoder, text_groups

SIZE = 2048
END_ID = 1
# Cost, in tokens of padding, of splitting a document at a sentence end or within a sentence.
SENTENCE_PENALTY = 8
HARD_PENALTY = 64
HARD_STEP = 64
SEGMENT_CUTS = 200_000
# A chunk of text after which a sentence ends.
SENTENCE_END = r"(?:[.!?。！？][\"')\]”’]*|\n\s*)$"
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
)


def best_cuts(ends: np.ndarray, penalties: np.ndarray, size: int) -> list[int]:
    """Indices into ``ends`` of the chosen cuts; the last one always is.

    ``ends`` ascend by steps of at most ``size``, from above zero.
    """
    n = len(ends)
    end, penalty = ends.tolist(), penalties.tolist()
    keys = [0] * n  # cost + end
    best = [0] * n
    queue: deque[tuple[int, int, int]] = deque([(0, 0, -1)])  # key, end, index: keys ascend
    for j in range(n):
        e = end[j]
        while queue[0][1] < e - size:
            queue.popleft()
        key, _, i = queue[0]
        best[j] = i
        total = key + size + penalty[j]  # cost[j] + end[j]
        keys[j] = total
        while queue and queue[-1][0] >= total:
            queue.pop()
        queue.append((total, e, j))
    cuts, j = [], n - 1
    while j >= 0:
        cuts.append(j)
        j = best[j]
    return cuts[::-1]


@dataclass
class _Segment:
    """Documents waiting to be packed."""

    docs: list[tuple[int | None, np.ndarray]] = field(default_factory=list)
    ends: list[np.ndarray] = field(default_factory=list)
    penalties: list[np.ndarray] = field(default_factory=list)
    tokens: int = 0
    cuts: int = 0

    def add(self, doc_id: int | None, ids: np.ndarray, sentences: np.ndarray) -> None:
        """``sentences`` are token counts at which a sentence ends, below the document's length."""
        n = len(ids)
        ends = np.append(sentences[sentences < n], n)
        penalties = np.full(len(ends), SENTENCE_PENALTY)
        penalties[-1] = 0
        gaps = np.diff(ends, prepend=0)
        if gaps.max() > HARD_STEP:
            # Every sentence's cuts, then those of long sentences in between.
            extra = (gaps - 1) // HARD_STEP
            first = np.repeat(ends - gaps, extra)
            inside = first + HARD_STEP * (np.arange(len(first)) - np.repeat(np.cumsum(extra) - extra, extra) + 1)
            at = np.repeat(np.arange(len(ends)), extra)
            ends, penalties = np.insert(ends, at, inside), np.insert(penalties, at, HARD_PENALTY)
        self.docs.append((doc_id, ids))
        self.ends.append(ends + self.tokens)
        self.penalties.append(penalties)
        self.tokens += n
        self.cuts += len(ends)

    def pieces(self, size: int, first: int) -> Iterator[tuple]:
        """Rows of every piece, sequences numbered from ``first``."""
        ends = np.concatenate(self.ends)
        cuts = ends[best_cuts(ends, np.concatenate(self.penalties), size)].tolist()
        sequence, low, at = 0, 0, 0  # current window starts at token ``low``
        for doc_id, ids in self.docs:
            start, n = 0, len(ids)
            while start < n:
                length = min(n - start, cuts[sequence] - at)
                part = ids[start : start + length].tobytes()
                yield (doc_id, start, length, zlib.crc32(part), n, first + sequence, at - low, part)
                start, at = start + length, at + length
                if at == cuts[sequence]:
                    sequence, low = sequence + 1, at

    def count(self) -> int:
        return len(self.docs)


def ordered(documents: DataFrame) -> DataFrame:
    """Ranges of ids as partitions, each in order."""
    rows = texts_of(documents)
    return rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")


def pack(
    documents: DataFrame, tokenizer_path: str, size: int = SIZE, end_id: int = END_ID, with_ids: bool = True
) -> DataFrame:
    """A row per piece of a document in a sequence; ``ids`` holds its tokens, 4 bytes each.

    ``sequence_id`` is the partition's number times 2**33 plus the sequence's place in it, so it
    ascends with the documents.
    """

    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        tokens = encoder(tokenizer_path, True, SENTENCE_END)
        segment = _Segment()

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal segment, number
            rows = list(segment.pieces(size, number))
            number = rows[-1][5] + 1
            segment = _Segment()
            for low in range(0, len(rows), 20_000):
                columns = list(zip(*rows[low : low + 20_000], strict=True))
                kinds = [pa.int64()] * 7
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)]
                ids = pa.array(columns[7] if with_ids else [None] * len(columns[0]), pa.binary())
                yield pa.RecordBatch.from_arrays([*arrays, ids], [x.split()[0] for x in PIECES.split(", ")])

        for batch in batches(iterator):
            ids = batch.column(0).to_pylist()
            row = 0
            for group in text_groups(batch.column(1)):
                for own, sentences in tokens.encode(group):
                    segment.add(ids[row], np.append(own, np.uint32(end_id)), sentences)
                    row += 1
                    if segment.cuts >= SEGMENT_CUTS or segment.tokens >= 8_000_000:
                        yield from flush()
        if segment.count():
            yield from flush()

    return ordered(documents).mapInArrow(lean(run, "encoder"), PIECES)
