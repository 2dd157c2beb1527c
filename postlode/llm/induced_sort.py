"""Suffix arrays by induced sorting, with the inner loops as array operations.

Suffixes are classed as S (smaller than the next) or L; leftmost S suffixes, the LMS ones, are sorted by the
names of their substrings, recursively, and all others follow from them: L suffixes from left to right, S
suffixes from right to left. Buckets are taken one character at a time; what a bucket induces into itself is
taken in waves, one per repetition of the character.
"""

from __future__ import annotations

import numpy as np

# Names of LMS substrings over a larger alphabet are ranked by doubling: one bucket at a time would be slow. Places are
# 32-bit numbers, so a text has less than 2^31 symbols.
LARGEST_ALPHABET = 2048


def _types(s: np.ndarray) -> np.ndarray:
    """True for S suffixes; the end is smaller than every character."""
    n = len(s)
    differs = np.append(s[1:] != s[:-1], True)
    smaller = np.append(s[:-1] < s[1:], False)
    at = np.where(differs, np.arange(n, dtype=np.int32), np.int32(n))
    return smaller[np.minimum.accumulate(at[::-1])[::-1]]


def _append(sa: np.ndarray, heads: np.ndarray, found: np.ndarray, chars: np.ndarray, step: int) -> None:
    """Put suffixes, in order, at the heads (step 1) or tails (step -1) of their characters' buckets."""
    order = np.argsort(chars, kind="stable")
    ordered = chars[order]
    edges = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    counts = np.diff(np.append(edges, len(ordered)))
    rank = np.arange(len(ordered)) - np.repeat(edges, counts)
    groups = ordered[edges]
    sa[np.repeat(heads[groups], counts) + step * rank] = found[order]
    heads[groups] += step * counts


def _induce(s: np.ndarray, is_s: np.ndarray, lms: np.ndarray, sigma: int) -> np.ndarray:
    """The suffix array that follows from LMS suffixes in the order given."""
    n = len(s)
    sa = np.full(n, -1, np.int32)
    counts = np.bincount(s, minlength=sigma)
    ends = np.cumsum(counts)
    starts = ends - counts
    present = np.flatnonzero(counts)
    by_char = np.argsort(s[lms], kind="stable")
    in_buckets = lms[by_char]
    cut = np.concatenate([[0], np.cumsum(np.bincount(s[lms], minlength=sigma))])
    heads = starts.copy()
    sa[heads[s[n - 1]]] = n - 1
    heads[s[n - 1]] += 1

    def left(batch: np.ndarray) -> None:
        before = batch[batch > 0] - 1
        before = before[~is_s[before]]
        if len(before):
            _append(sa, heads, before, s[before], 1)

    for c in present.tolist():
        done = starts[c]
        while done < heads[c]:
            low, done = done, int(heads[c])
            left(sa[low:done])
        group = in_buckets[cut[c] : cut[c + 1]]
        if len(group):
            left(group)
    tails = ends - 1

    def right(batch: np.ndarray) -> None:
        before = batch[batch > 0] - 1
        before = before[is_s[before]]
        if len(before):
            _append(sa, tails, before, s[before], -1)

    for c in present[::-1].tolist():
        done = ends[c] - 1
        while done > tails[c]:
            high, done = done, int(tails[c])
            right(sa[done + 1 : high + 1][::-1])
        # S suffixes fill the bucket's end; what is left of it are L suffixes.
        if heads[c] > starts[c]:
            right(sa[starts[c] : heads[c]][::-1])
    return sa


def _words(s: np.ndarray, more: int) -> tuple[np.ndarray, int]:
    """For each place of ``s`` and ``more`` beyond its end, the 8 bytes from there on, and how many characters these are."""
    size = s.dtype.itemsize
    padded = np.concatenate([s.astype(f"<u{size}"), np.zeros(more + 8, f"<u{size}")])
    return np.ndarray(len(s) + more, "<u8", padded.data, strides=(size,)), 8 // size


def _names(s: np.ndarray, is_s: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Names of the LMS substrings, equal ones alike, in the order of the text."""
    n, m = len(s), len(lms)
    length = np.zeros(n, np.int32)
    # A substring reaches to the next LMS position; the last one is unlike all others.
    length[lms[:-1]] = np.diff(lms) + 1
    length[lms[-1]] = n - lms[-1] + 1
    a, b = ordered[:-1], ordered[1:]
    same = (length[a] == length[b]) & (a != lms[-1]) & (b != lms[-1])
    rest = np.flatnonzero(same)
    a, b, left = a[rest], b[rest], length[a[rest]]
    words, step = _words(s, 1)
    # Of the last characters compared at once, those beyond the substring do not count.
    masks = np.array([(1 << 64 // step * k) - 1 for k in range(step + 1)], np.uint64)
    while len(rest):
        equal = (words[a] ^ words[b]) & masks[np.minimum(left, step)] == 0
        same[rest[~equal]] = False
        going = equal & (left > step)
        rest, a, b, left = rest[going], a[going] + step, b[going] + step, left[going] - step
    names = np.empty(n, np.int32)
    names[ordered] = np.concatenate([[0], np.cumsum(~same)])
    return names[lms]


def _by_doubling(s: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes by ``depth`` characters; a round sorts by several ranks at once those that still are alike."""
    rank, k, n = s.astype(np.int64), 1, len(s)
    alike, slots, order = np.arange(n), np.arange(n), np.empty(n, np.int64)
    while True:
        base = int(rank.max(initial=0)) + 2
        times = max(2, min(62 // base.bit_length(), -(-depth // k)))
        key = rank[alike]
        for j in range(1, times):
            after = alike + j * k
            inside = after < n
            key *= base
            key[inside] += rank[after[inside]] + 1
        by_key = np.argsort(key)
        ordered = key[by_key]
        alike = order[slots] = alike[by_key]
        # The rank is the first place of those alike.
        new = np.append(True, ordered[1:] != ordered[:-1])
        if k == 1:
            rank = np.empty(n, np.int64)
        rank[alike] = slots[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        k *= times
        lone = new & np.append(new[1:], True)
        alike, slots = alike[~lone], slots[~lone]
        if not len(alike) or k >= depth:
            return order


def suffix_array(s: np.ndarray, sigma: int, depth: int | None = None) -> np.ndarray:
    """Starts of the suffixes of ``s`` in order; its values are below ``sigma``.

    With a ``depth``, suffixes that agree on so many characters may come in any order.
    """
    n = len(s)
    if sigma <= 1 << 16:
        s = s.astype(np.uint8 if sigma <= 1 << 8 else np.uint16)  # numpy sorts these by radix
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    if sigma > LARGEST_ALPHABET:
        return _by_doubling(s, depth or n)
    is_s = _types(s)
    lms = (np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1).astype(np.int32)
    if not len(lms):
        return _induce(s, is_s, lms, sigma)
    rough = _induce(s, is_s, lms, sigma)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    ordered = rough[is_lms[rough]]
    names = _names(s, is_s, lms, ordered)
    most = int(names.max()) + 1
    # Each name but the last stands for two characters or more.
    below = depth // 2 + 1 if depth else None
    order = np.argsort(names) if most == len(lms) else suffix_array(names, most, below)
    return _induce(s, is_s, lms[order], sigma)


def permuted_prefixes(data: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """For each suffix in text order, its common prefix with the one before it in ``sa``, up to ``most``.

    ``data`` holds symbols of 8 or 16 bits; zero separates strings and matches nothing. Eight bytes are compared at once.
    """
    n = len(data)
    before = np.full(n, -1, np.int32)
    before[sa[1:]] = sa[:-1]
    words, step = _words(data, most)
    plcp = np.zeros(n, np.int32)
    rest = np.flatnonzero(before >= 0).astype(np.int32)
    other = before[rest]
    for k in range(0, most, step):
        differ = words[rest + k] ^ words[other + k]
        equal = differ == 0
        found = differ[~equal]
        # The lowest bit that differs tells how many of the symbols agree.
        lowest = found & (~found + np.uint64(1))
        plcp[rest[~equal]] = k + np.bitwise_count(lowest - np.uint64(1)) // (64 // step)
        rest, other = rest[equal], other[equal]
        if not len(rest):
            break
    plcp[rest] = most
    zeros = np.flatnonzero(data == 0).astype(np.int32)
    ends = np.append(zeros, np.int32(n))
    left = np.repeat(ends, np.diff(ends, prepend=np.int32(-1)))[:n] - np.arange(n, dtype=np.int32)
    return np.minimum(plcp, left, out=plcp)
