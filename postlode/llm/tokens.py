"""Token ids of whole texts by the tokenizers library, with a bounded memory of chunks seen.

The library splits a text into pieces before it merges bytes, and no piece crosses the chunk borders
used here. So a text's ids are its chunks' ids in a row, and a chunk seen before costs one look-up by
its digest of 128 bits.
Chunks not seen are joined, encoded in one call, and their ids told apart by byte counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer
from xxhash import xxh3_128_digest

from postlode.llm.shared import worker_cache

# Chunks that a worker remembers at most, and how many it keeps then. This bounds memory, not results.
MEMORY, KEPT = 500_000, 250_000
# A blank belongs to what follows it; of other white space before a word, the last character stands alone.
_SPACED = re.compile(r" ?\S+|\s+(?!\S)|\s+")


def byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in byte-level vocabularies: printable ones for themselves."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


def _places(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices of all runs of ``counts`` from ``starts``, in a row."""
    ends = np.cumsum(counts, dtype=np.int32)
    places = np.repeat(starts - (ends - counts), counts)
    places += np.arange(len(places), dtype=np.int32)
    return places


class ChunkEncoder:
    """Encodes texts chunk by chunk; ``keeps_space`` for vocabularies whose ids cover all bytes.

    ``marks`` is a pattern; the encoder tells after which chunks it is found.
    """

    def __init__(self, path: str, keeps_space: bool, marks: str | None = None):
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        self._keeps_space = keeps_space
        self._marks = re.compile(marks) if marks else None
        alphabet = byte_alphabet()
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self._bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            plain = token if keeps_space else token.removesuffix("</w>")
            self._bytes[number] = sum(c in alphabet for c in plain)
        # Digests of the chunks seen, in the order of their first halves, and the number of each chunk: texts of chunks are not held.
        self._digests = np.empty((0, 2), np.uint64, order="F")
        self._number = np.empty(0, np.int32)
        # By number: the ids' place in ``_flat``, their count, whether the chunk is marked, how often it was met.
        self._flat = np.empty(0, np.uint32)
        self._starts = np.empty(0, np.int32)
        self._counts = np.empty(0, np.int32)
        self._marked = np.empty(0, bool)
        self._uses = np.empty(0, np.uint32)

    def _forget(self) -> None:
        """Keep the chunks met most often, in their order; of those met as often the ones seen first."""
        kept = np.sort(np.argsort(~self._uses, kind="stable")[:KEPT])
        there = np.full(len(self._uses), -1, np.int32)
        there[kept] = np.arange(len(kept), dtype=np.int32)
        number = there[self._number]
        self._digests, self._number = np.asfortranarray(self._digests[number >= 0]), number[number >= 0]
        counts = self._counts[kept]
        starts = np.cumsum(counts, dtype=np.int32) - counts
        self._flat = self._flat[_places(self._starts[kept], counts)]
        self._starts, self._counts, self._marked = starts, counts, self._marked[kept]
        self._uses = self._uses[kept] // 2  # so that what was frequent long ago can go

    def _ids(self, text: str) -> np.ndarray:
        # The call that tells no offsets.
        return np.array(self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _joint(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids of the chunks in one call, with each chunk's place; None if the bytes do not add up."""
        if self._keeps_space:
            # A line feed before a word is an id of its own; it is left out again.
            led = [c if c[0] == " " else "\n" + c for c in chunks]
            lead = np.array([c[0] != " " for c in chunks], np.int64)
            whole, sizes = "".join(led), [len(c.encode()) for c in led]
        else:
            whole = " ".join(chunks)
            sizes = [len(p.encode()) for p in self._tokenizer.normalizer.normalize_str(whole).split(" ")]
            lead = np.zeros(len(chunks), np.int64)
        ids = self._ids(whole)
        reached, ends = np.cumsum(self._bytes[ids]), np.cumsum(sizes)
        if len(ends) != len(chunks) or not len(ids) or reached[-1] != ends[-1]:
            return None
        cuts = np.searchsorted(reached, ends) + 1
        if not (reached[cuts - 1] == ends).all():
            return None
        starts = np.concatenate([[0], cuts[:-1]]) + lead
        return ids, starts, cuts - starts

    def _learn(self, chunks: list[str]) -> None:
        starts, counts = np.zeros(len(chunks), np.int32), np.zeros(len(chunks), np.int32)
        base, parts = len(self._flat), [self._flat]
        safe = np.array([not (self._keeps_space and c.isspace()) for c in chunks], bool)
        together, alone = np.flatnonzero(safe), np.flatnonzero(~safe).tolist()
        for low in range(0, len(together), 20_000):
            group = together[low : low + 20_000]
            done = self._joint([chunks[i] for i in group])
            if done is None:
                alone.extend(group.tolist())
                continue
            ids, begin, number = done
            starts[group], counts[group] = begin + base, number
            parts.append(ids)
            base += len(ids)
        for i in alone:
            ids = self._ids(chunks[i])
            starts[i], counts[i] = base, len(ids)
            parts.append(ids)
            base += len(ids)
        self._flat = np.concatenate(parts)
        self._starts = np.concatenate([self._starts, starts])
        self._counts = np.concatenate([self._counts, counts])
        found = [self._marks is not None and self._marks.search(c) is not None for c in chunks]
        self._marked = np.concatenate([self._marked, np.array(found, bool)])
        self._uses = np.concatenate([self._uses, np.zeros(len(chunks), np.uint32)])

    def _seen(self, digests: np.ndarray) -> np.ndarray:
        """The chunks' numbers, -1 for those not seen."""
        first, second = self._digests[:, 0], self._digests[:, 1]
        numbers, at = np.full(len(digests), -1, np.int32), np.searchsorted(first, digests[:, 0])
        left = np.flatnonzero(at < len(first))
        while len(left):  # once more only if two chunks share a first half
            left = left[first[at[left]] == digests[left, 0]]
            hit = second[at[left]] == digests[left, 1]
            numbers[left[hit]] = self._number[at[left[hit]]]
            left = left[~hit]
            at[left] += 1
            left = left[at[left] < len(first)]
        return numbers

    def _numbers(self, chunks: list[str]) -> np.ndarray:
        """The chunks' numbers, after those not seen are learnt; 128 bits tell chunks apart."""
        digests = np.frombuffer(b"".join(map(xxh3_128_digest, chunks)), np.uint64).reshape(-1, 2)
        numbers = self._seen(digests)
        unknown = np.flatnonzero(numbers < 0)
        if len(unknown):
            # One of equal chunks, in the order of appearance.
            at = np.sort(np.unique(digests[unknown].view("S16"), return_index=True)[1])
            fresh = digests[unknown[at]]
            order = np.argsort(fresh[:, 0], kind="stable")
            places = np.searchsorted(self._digests[:, 0], fresh[order, 0])
            self._number = np.insert(self._number, places, (len(self._counts) + order).astype(np.int32))
            self._digests = np.asfortranarray(np.insert(self._digests, places, fresh[order], axis=0))
            self._learn([chunks[i] for i in unknown[at].tolist()])
            numbers[unknown] = self._seen(digests[unknown])
        return numbers

    def _words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Chunk numbers of all texts in a row, and how many each text has; white space is left out."""
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        filled = np.array([bool(w) for w in words], bool)  # outer white space gives empty words
        table = np.zeros(len(words), np.int32)
        table[filled] = self._numbers([w for w in words if w])
        at = coded.indices.to_numpy()
        offsets = split.offsets.to_numpy()
        kept = filled[at]
        there = np.concatenate([[0], np.cumsum(kept)])
        return table[at[kept]], np.diff(there[offsets - offsets[0]])

    def _spaced(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same with white space kept: lines are split at single blanks, odd texts by the pattern."""
        lines = pc.split_pattern(texts, "\n")
        split = pc.split_pattern(lines.flatten(), " ")
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        odd = np.array([not w or w != w.strip() for w in words], bool)
        at = coded.indices.to_numpy()
        of_line, of_word = lines.offsets.to_numpy(), split.offsets.to_numpy()
        of_line, of_word = of_line - of_line[0], of_word - of_word[0]
        key = at * 2 + 1
        key[of_word[:-1]] -= 1  # the first word of a line has no blank before it
        there = np.zeros(2 * len(words), bool)
        there[key] = True
        keys = np.flatnonzero(there)
        usable = ~odd[keys >> 1]
        plain = [" " + words[k >> 1] if k & 1 else words[k >> 1] for k in keys[usable].tolist()]
        table = np.zeros(len(there), np.int32)
        table[keys[usable]] = self._numbers(plain)
        # A line feed before each line but a text's first.
        later = np.ones(len(split), bool)
        later[of_line[:-1]] = False
        numbers = np.insert(table[key], of_word[:-1][later], self._numbers(["\n"])[0])
        chunks = np.diff(of_word[of_line]) + np.diff(of_line) - 1
        again = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(odd[at])])[of_word[of_line]]))
        if not len(again):
            return numbers, chunks
        parts = np.split(numbers, np.cumsum(chunks)[:-1])
        for i in again.tolist():
            parts[i] = self._numbers(_SPACED.findall(texts[i].as_py()))
        return np.concatenate(parts), np.array([len(x) for x in parts], np.int64)

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each text its ids and the id counts after its marked chunks. Null is as empty."""
        if not len(texts):
            return
        if len(self._counts) > MEMORY:
            self._forget()
        texts = pc.fill_null(texts, "")
        numbers, chunks = self._spaced(texts) if self._keeps_space else self._words(texts)
        self._uses += np.bincount(numbers, minlength=len(self._uses)).astype(np.uint32)
        counts = self._counts[numbers]
        reached = np.cumsum(counts)
        ids = self._flat[_places(self._starts[numbers], counts)]
        marked = self._marked[numbers]
        begin = low = 0
        for high in np.cumsum(chunks).tolist():
            places = reached[low:high]
            end = int(places[-1]) if high > low else begin
            yield ids[begin:end], places[marked[low:high]] - begin
            begin, low = end, high


def encoder(path: str, keeps_space: bool, marks: str | None = None) -> ChunkEncoder:
    """One per worker process."""
    cache, key = worker_cache(), ("encoder", path, keeps_space, marks)
    if key not in cache:
        cache[key] = ChunkEncoder(path, keeps_space, marks)
    return cache[key]


def text_groups(texts: pa.Array, most: int = 4_000_000) -> Iterator[pa.Array]:
    """Consecutive texts, about ``most`` bytes together, to bound memory."""
    low, size = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        size += n
        if size >= most:
            yield texts.slice(low, i + 1 - low)
            low, size = i + 1, 0
    if low < len(texts):
        yield texts.slice(low)
