"""Line-first cleaning: rules per line, failing lines removed, documents that lose too much rejected.

A line fails by one of these rules, tried in this order:

* ``boilerplate``: it holds a phrase of licences, notices and banners and has at most 40 words;
* ``navigation``: many separators between short items, or a few link words and no sentence;
* ``punctuation``: more signs than prose has, marks piled up at word ends, capitals throughout,
  or, in a long line, no mark at all;
* ``repetition``: one word, or one pair of words, makes up most of it.

A document is kept if it passes the base checks and its remaining lines hold at least ``MIN_KEPT`` of
its words. Lines without a word are neither judged nor removed.

Edge cases: a null or empty text has no words and fails the base checks. Every row, also a repeated one or one with a
null id, gets a result. Long texts are read whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from postlode.llm.shared import batches, byte_texts, texts_of

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
MIN_KEPT = 0.5
SYMBOLS = b"#*$%&|<>"
_NOT_SYMBOLS = bytes(b for b in range(256) if b not in SYMBOLS)
_CONTINUATION = bytes(range(0x80, 0xC0))
# Phrases of lines that are about the page and not of it.
BOILERPLATE = (
    "all rights reserved", "licensed under", "released under the", "creative commons", "gnu general public license",
    "apache license", "mit license", "cookie policy", "privacy policy", "terms of service", "terms of use",
    "accept cookies", "enable javascript", "lorem ipsum", "subscribe to our newsletter", "copyright (c)", "©",
)
LINKS = (
    "home", "about", "contact", "login", "log in", "sign in", "sign up", "register", "menu", "search", "next", "previous",
    "back to top", "read more", "share", "skip to content", "sitemap", "click here",
)
_BOILERPLATE = re.compile("|".join(map(re.escape, BOILERPLATE)).encode())
_LINK = re.compile(rb"\b(?:" + "|".join(map(re.escape, LINKS)).encode() + rb")\b")
_SEPARATORS = tuple(x.encode() for x in "|»›•·→")
_PILED = re.compile(rb"(?:[!?]{2,}|[#*$%&]{2,})[.,;:]*$")
_MARK = re.compile(rb"[.!?,;:]")
RULES = ("boilerplate", "navigation", "punctuation", "repetition")


def failing_rule(line: bytes) -> str | None:
    """The first rule a line with words fails; None for prose."""
    words = line.split()
    n = len(words)
    low = line.lower()
    if n <= 40 and _BOILERPLATE.search(low):
        return "boilerplate"
    separators = sum(map(line.count, _SEPARATORS))
    if separators >= 3 and separators * 4 >= n - separators:
        return "navigation"
    if n <= 8 and len(_LINK.findall(low)) * 2 >= n and not line.rstrip().endswith((b".", b"!", b"?")):
        return "navigation"
    signs = len(line.translate(None, _NOT_SYMBOLS))
    if signs * 10 > len(line):
        return "punctuation"
    if n >= 3:
        piled = sum(w[-1] < 0x40 and _PILED.search(w) is not None for w in words)
        if piled * 10 >= 3 * n:
            return "punctuation"
        if n >= 8:
            letters = sum(w.isupper() and len(w) > 1 for w in words)
            if letters * 10 >= 7 * n:
                return "punctuation"
    if n >= 60 and not _MARK.search(line):
        return "punctuation"
    if n >= 10:
        counts = Counter(words)
        if counts.most_common(1)[0][1] * 10 >= 4 * n:
            return "repetition"
        if n >= 16 and len(counts) * 4 <= n:
            return "repetition"
    return None


def repeated_words(codes: np.ndarray, base: int) -> int:
    """Words inside 3-word windows that the text holds twice or more; ``codes`` are below ``base``."""
    if len(codes) < 4:
        return 0
    windows = (codes[:-2] * base + codes[1:-1]) * base + codes[2:]
    order = np.argsort(windows, kind="stable")
    ordered = windows[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return 0
    found = np.zeros(len(windows), bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    covered = np.zeros(len(codes), bool)
    for shift in range(3):
        covered[shift : shift + len(windows)] |= found
    return int(covered.sum())


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, and words in repeated windows."""
    words = text.split()
    joined = b"".join(words)
    symbols = len(text.translate(None, _NOT_SYMBOLS))
    seen: set[bytes] = set()
    repeated_lines = 0
    for line in text.split(b"\n"):
        if line in seen:
            repeated_lines += bool(line.split())
        else:
            seen.add(line)
    numbers: dict[bytes, int] = {}
    codes = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    if len(numbers) < 2_000_000:  # three codes fit 63 bits
        repeated = repeated_words(codes, max(1, len(numbers)))
    else:
        pairs, first = np.unique(np.stack([codes[:-1], codes[1:]], axis=1), axis=0, return_inverse=True)
        _, windows = np.unique(np.stack([first[:-1], codes[2:]], axis=1), axis=0, return_inverse=True)
        times = np.bincount(windows)[windows] > 1
        covered = np.zeros(len(codes), bool)
        for shift in range(3):
            covered[shift : shift + len(times)] |= times
        repeated = int(covered.sum())
    return len(words), len(joined.translate(None, _CONTINUATION)), symbols, repeated_lines, repeated


def clean(text: bytes) -> tuple[bytes, Counter, int]:
    """The text without its failing lines, how many failed each rule, and the words lost."""
    kept, failed, lost = [], Counter(), 0
    for line in text.split(b"\n"):
        n = len(line.split())
        rule = failing_rule(line) if n else None
        if rule:
            failed[rule] += 1
            lost += n
        else:
            kept.append(line)
    return b"\n".join(kept), failed, lost


JUDGED = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_failed_lines long, n_lost_words long, "
    + ", ".join(f"n_{r} long" for r in RULES)
    + ", clean_text string"
)


def judge(documents: DataFrame, min_kept: float = MIN_KEPT) -> DataFrame:
    """A row per document: base counts, verdict, lines that failed each rule, and the cleaned text."""
    names = [x.split()[0] for x in JUDGED.split(", ")]
    booleans = {"base_failed", "kept"}

    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(iterator):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1)), strict=True):
                counts = base_counts(text)
                n, repeated = counts[0], counts[4]
                base_failed = n < MIN_WORDS or 100 * repeated > MAX_REPEATED_PERCENT * n
                cleaned, failed, lost = clean(text)
                kept = not base_failed and n - lost >= min_kept * n
                rows.append(
                    (doc_id, *counts, base_failed, kept, sum(failed.values()), lost, *(failed[r] for r in RULES), cleaned)
                )
            columns = [
                pa.array(c, pa.bool_()) if name in booleans
                else pa.array(c, pa.binary()).cast(pa.string()) if name == "clean_text"
                else pa.array(c, pa.int64())
                for name, c in zip(names, zip(*rows, strict=True), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    return texts_of(documents).mapInArrow(run, JUDGED)
