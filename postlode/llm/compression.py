"""Quality classifier by compression: a text is good if the good dictionary packs it better.

Two zstandard dictionaries are built, one of texts labelled good and one of texts labelled
bad. A text's feature is ``bad size - good size``, its two compressed sizes summed over blocks of
one size, over the root of its length: the chance part of such a sum grows with the root. A logistic
curve, fitted on labelled texts that neither dictionary holds, turns the feature into a probability of label 1.

Edge cases: a null or empty text has feature 0 and the score that the curve gives there. Rows with
null labels or null ids are not learnt from; every input row gets a score, repeated rows each
their own. With no label of one class every score is the share of good labels, or 0.5 without any.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from postlode.llm.shared import batches, byte_texts, lean, stored

# The bound of the fit: so many labelled texts of each class at most, of so many bytes each, those with
# the smallest hash of the id. One in CURVE_SHARE fits the curve, the others fill the dictionary.
SAMPLE_ROWS = 2000
SAMPLE_TEXT_BYTES = 32_768
CURVE_SHARE = 4
# Bytes of one dictionary; the texts of the sample share them evenly, so none crowds out others.
DICTIONARY_BYTES = 400_000
# Bytes that a long text gives at a time; by the defaults each gives four windows.
WINDOW_BYTES = 64
LEVEL = 3
# A text is compressed in blocks of so many bytes, in the fit and in scores, so the dictionaries are in reach
# everywhere: behind the compressor's window (2 MB at this level) they would tell nothing more.
BLOCK_BYTES = 16_384


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    slope: float
    intercept: float


def _dictionary(texts: list[bytes], size: int) -> bytes:
    """Raw content of up to ``size`` bytes: of every text, windows of one size from all over it.

    A text gives as many windows as its share holds, evenly spaced from an offset hashed from the text.
    So every part of the texts is taken alike, however many texts there are.
    """
    if not texts:
        return b""
    pieces = max(1, size // len(texts) // (WINDOW_BYTES + 1))
    parts, total = [], 0
    for text in texts:
        if total >= size:
            break
        if len(text) <= pieces * WINDOW_BYTES:
            windows = [text]
        else:
            shift, step = zlib.crc32(text) / 2**32, (len(text) + WINDOW_BYTES) / pieces
            # A window may begin before the text or end behind it, so its edges are taken alike too.
            starts = (int((i + shift) * step) - WINDOW_BYTES for i in range(pieces))
            windows = [text[max(0, at) : at + WINDOW_BYTES] for at in starts]
        parts.extend(windows)
        total += sum(len(w) + 1 for w in windows)
    return b"\n".join(parts)[:size]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    plain = {"level": LEVEL, "write_checksum": False, "write_content_size": False, "write_dict_id": False}
    if len(content) < 8:
        return zstandard.ZstdCompressor(**plain)
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=dictionary, **plain)


class Sizes:
    """Normalised compressed-size differences of texts under two dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        self._good, self._bad = _compressor(good), _compressor(bad)

    def feature(self, text: bytes) -> float:
        if not text:
            return 0.0
        difference = 0
        for at in range(0, len(text), BLOCK_BYTES):
            block = text[at : at + BLOCK_BYTES]
            difference += len(self._bad.compress(block)) - len(self._good.compress(block))
        return difference / math.sqrt(len(text))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept by Newton steps on targets smoothed as Platt proposed."""
    n1, n0 = float((y == 1).sum()), float((y == 0).sum())
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    scale = float(x.std()) or 1.0
    design = np.stack([x / scale, np.ones(len(x))], axis=1)
    beta = np.array([0.0, math.log((n1 + 1) / (n0 + 1))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (p - target) + 1e-3 * beta
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def fit(
    documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, size: int = DICTIONARY_BYTES
) -> Model:
    """A model from ``doc_id, text`` and ``doc_id, label`` rows.

    At most ``sample_rows`` texts per class reach the driver: the documented bound of the fit.
    The choice follows a hash of the id, so it is the same on every run and for every layout.
    Ids and lengths alone are shuffled for it.
    """
    lengths = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("n_bytes")
    ).where("doc_id is not null")
    known = labels.where("label in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), "label").distinct()
    rows = stored(lengths.join(known, "doc_id"), "labelled-ids")
    picked = None
    for label in (0, 1):
        of_class = (
            rows.where((F.col("label") == label) & (F.col("n_bytes") <= SAMPLE_TEXT_BYTES))
            .select("doc_id", "label", F.xxhash64("doc_id").alias("h"))
            .distinct()
            .orderBy("h", "doc_id")
            .limit(sample_rows)
        )
        picked = of_class if picked is None else picked.unionByName(of_class)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Twice ``sample_rows`` ids at most are broadcast.
    picked = texts.join(F.broadcast(picked), "doc_id").where(
        F.coalesce(F.octet_length("text"), F.lit(0)) <= SAMPLE_TEXT_BYTES
    )
    sample: dict[int, list[bytes]] = {0: [], 1: []}
    for row in sorted(picked.collect(), key=lambda r: (r.h, r.doc_id, r.text or "")):
        sample[row.label].append((row.text or "").encode())
    if not sample[0] or not sample[1]:
        n0, n1 = len(sample[0]), len(sample[1])
        return Model(b"", b"", 0.0, math.log((n1 + 0.5) / (n0 + 0.5)) if n0 + n1 else 0.0)
    rest = {label: texts[::CURVE_SHARE] for label, texts in sample.items()}
    filling = {
        label: [t for i, t in enumerate(texts) if i % CURVE_SHARE] or texts for label, texts in sample.items()
    }
    good, bad = _dictionary(filling[1], size), _dictionary(filling[0], size)
    sizes = Sizes(good, bad)
    x = np.array([sizes.feature(t) for label in (0, 1) for t in rest[label]])
    y = np.array([label for label in (0, 1) for _ in rest[label]])
    slope, intercept = _logistic(x, y)
    # The sample may hold the classes in other shares than the labels do; shift to theirs.
    counts = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    shift = math.log(counts[1] / counts[0]) - math.log(len(rest[1]) / len(rest[0]))
    return Model(good, bad, slope, intercept + shift)


def score(documents: DataFrame, model: Model, text: str = "text", to: str = "score") -> DataFrame:
    """The documents with a score between 0 and 1; all blocks of every text are compressed twice."""
    shared = documents.sparkSession.sparkContext.broadcast(model)  # twice DICTIONARY_BYTES at most
    schema = StructType([*documents.schema.fields, StructField(to, DoubleType())])
    at = documents.columns.index(text)

    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        sizes = Sizes(m.good, m.bad)
        for batch in batches(iterator):
            features = np.array([sizes.feature(t) for t in byte_texts(batch.column(at))])
            z = np.clip(m.slope * features + m.intercept, -700, 700)
            columns = [*batch.columns, pa.array(1 / (1 + np.exp(-z)), pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, to])

    return documents.mapInArrow(lean(run), schema)
