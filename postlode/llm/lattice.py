"""Language-model scores from a subword lattice.

The vocabulary is that of an existing tokenizer file, ids and order as they are. Its scores start from the
ranks the file gives and are re-estimated from the distinct training words by expectation
maximisation over all segmentations. A word's subword probability is the sum over all its segmentations,
found by the forward recursion in log space. Training words are lattice edges too: with ``c`` the word's count, ``N``
training tokens and ``V`` distinct ones, ``P(word) = (c + V * P_subword(word)) / (N + V)``. A text's
score is the sum over its words and its end of ``log10 P``, its marginal probability.

The model spreads a share of its mass over all words that training never saw, by their spelling. The add-one base gives
every unseen word the mass of one, so it is no distribution, and it is higher on texts with many
unseen words.

Words meet their counts in two ways. The ``HOT_WORDS`` most frequent words, a bounded table, are sent to every task;
all other words, none of which is frequent, go through a join on the word. Each distinct word is
put through the lattice once, however often it occurs.

Edge cases: a null or empty text is its end alone. Every row is scored on its own, repeated ids
too; a null id has remainder 0, so it trains. Without training tokens words have their subword probability and
an end has probability 1. Very long words take a scalar form of the same recursion.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlode.llm.shared import batches, discard, stored

HOT_WORDS = 200_000
HOT_WORD_BYTES = 64
# Rounds of expectation maximisation, each over all distinct training words.
ROUNDS = 4
# Text that a task counts at once.
GROUP_BYTES = 6 << 20
# Words of more bytes are scored one by one.
VECTOR_BYTES = 40
PRIOR = 0.1
SPACE = "▁".encode()
END = b""
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MIXER = np.uint64(0xBF58476D1CE4E5B9)


def read_pieces(path: str) -> list[bytes]:
    """Pieces of a sentencepiece file in the file's order, the 256 single bytes first."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = [bytes([b]) for b in range(256)]
    seen = set(found)
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i).encode()
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) and piece not in seen:
            seen.add(piece)
            found.append(piece)
    return found


def rank_scores(n: int) -> np.ndarray:
    """Log probabilities that fall with the rank as word frequencies do."""
    weights = 1.0 / (np.arange(n) + 10.0)
    return np.log(weights / weights.sum())


class Lattice:
    """Sums over all segmentations of words into pieces; single bytes make every word possible."""

    def __init__(self, pieces: list[bytes], scores: np.ndarray):
        self.scores = scores
        self._index = {p: i for i, p in enumerate(pieces)}
        self._longest = max(map(len, pieces))
        self._powers = np.array([pow(int(_MULTIPLIER), k, 1 << 64) for k in range(VECTOR_BYTES + 1)], np.uint64)
        hashes = np.array([self._hash(p) for p in pieces], np.uint64)
        self._hashes = np.append(hashes, np.uint64(0))
        # Slots of the hash's top bits, in as many levels as pieces share a slot.
        self._levels: list[np.ndarray] = []
        left = np.flatnonzero([len(p) > 1 for p in pieces])
        while len(left):
            table = np.full(1 << 20, len(pieces), np.int32)
            slots = self._slots(hashes[left])
            _, first = np.unique(slots, return_index=True)
            table[slots[first]] = left[first]
            self._levels.append(table)
            left = np.delete(left, first)
        self._padded = np.append(scores, -np.inf)

    @staticmethod
    def _hash(piece: bytes) -> int:
        value = 0
        for byte in piece:
            value = (value * int(_MULTIPLIER) + byte + 1) % (1 << 64)
        return value

    @staticmethod
    def _slots(hashes: np.ndarray) -> np.ndarray:
        return (((hashes ^ (hashes >> np.uint64(29))) * _MIXER) >> np.uint64(44)).astype(np.int64)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the pieces with these hashes, two bytes or longer; the number of pieces for none."""
        slots = self._slots(hashes)
        none = len(self._hashes) - 1
        found = np.full(len(hashes), none, np.int64)
        for table in self._levels:
            number = table[slots]
            found = np.where((self._hashes[number] == hashes) & (number < none), number, found)
        return found

    def _edges(self, words: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
        """Piece numbers by start and end for words of one length, as rows of a byte matrix."""
        n, length = words.shape
        prefix = np.zeros((length + 1, n), np.uint64)
        for i in range(length):
            prefix[i + 1] = prefix[i] * _MULTIPLIER + words[:, i].astype(np.uint64) + np.uint64(1)
        edges = {}
        for end in range(1, length + 1):
            for start in range(max(0, end - self._longest), end):
                if end - start == 1:
                    edges[start, end] = words[:, start].astype(np.int64)
                    continue
                number = self._find(prefix[end] - prefix[start] * self._powers[end - start])
                if (number < len(self._hashes) - 1).any():
                    edges[start, end] = number
        return edges

    def _forward(self, edges: dict[tuple[int, int], np.ndarray], n: int, length: int) -> np.ndarray:
        alpha = np.full((length + 1, n), -np.inf)
        alpha[0] = 0
        for (start, end), number in sorted(edges.items(), key=lambda e: e[0][1]):
            alpha[end] = np.logaddexp(alpha[end], alpha[start] + self._padded[number])
        return alpha

    def _by_length(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Indices and byte matrices of the words short enough, some of one length at a time."""
        lengths = np.array([len(w) for w in words])
        for length in np.unique(lengths[(lengths > 0) & (lengths <= VECTOR_BYTES)]).tolist():
            there = np.flatnonzero(lengths == length)
            # So many words that all their substrings' numbers stay in the cache.
            some = max(64, 400_000 // length**2)
            for low in range(0, len(there), some):
                rows = there[low : low + some]
                data = b"".join(words[i] for i in rows.tolist())
                yield rows, np.frombuffer(data, np.uint8).reshape(len(rows), length)

    def _arcs(self, word: bytes, end: int) -> Iterator[tuple[int, int]]:
        for start in range(max(0, end - self._longest), end):
            number = self._index.get(word[start:end])
            if number is not None:
                yield start, number

    def _scalar(self, word: bytes) -> list[float]:
        alpha = [0.0]
        for end in range(1, len(word) + 1):
            terms = [alpha[start] + self.scores[number] for start, number in self._arcs(word, end)]
            most = max(terms)
            alpha.append(most + math.log(sum(math.exp(t - most) for t in terms)))
        return alpha

    def log_probability(self, words: list[bytes]) -> np.ndarray:
        """Natural log of the sum over all segmentations of each word."""
        result = np.zeros(len(words))
        for rows, matrix in self._by_length(words):
            result[rows] = self._forward(self._edges(matrix), *matrix.shape)[-1]
        for i, word in enumerate(words):
            if len(word) > VECTOR_BYTES:
                result[i] = self._scalar(word)[-1]
        return result

    def expected_counts(self, words: list[bytes]) -> np.ndarray:
        """Expected number of each piece over all segmentations, every word counted once."""
        counts = np.zeros(len(self._hashes))
        for _, matrix in self._by_length(words):
            n, length = matrix.shape
            edges = self._edges(matrix)
            alpha = self._forward(edges, n, length)
            beta = np.full((length + 1, n), -np.inf)
            beta[length] = 0
            for (start, end), number in sorted(edges.items(), key=lambda e: -e[0][0]):
                beta[start] = np.logaddexp(beta[start], beta[end] + self._padded[number])
            for (start, end), number in edges.items():
                share = np.exp(alpha[start] + self._padded[number] + beta[end] - alpha[length])
                counts += np.bincount(number, share, len(counts))
        for word in words:
            if len(word) > VECTOR_BYTES:
                self._count_scalar(word, counts)
        return counts[:-1]

    def _count_scalar(self, word: bytes, counts: np.ndarray) -> None:
        alpha = self._scalar(word)
        beta = [-math.inf] * len(word) + [0.0]
        for end in range(len(word), 0, -1):
            for start, number in self._arcs(word, end):
                arc = beta[end] + self.scores[number]
                low, high = sorted((beta[start], arc))
                beta[start] = high if low == -math.inf else high + math.log1p(math.exp(low - high))
                counts[number] += math.exp(alpha[start] + arc - alpha[-1])


def _word_groups(iterator: Iterator[pa.RecordBatch], most: int = 60_000) -> Iterator[pa.Table]:
    """Batches of words joined: array operations want many words of each length."""
    waiting, n = [], 0
    for batch in batches(iterator):
        waiting.append(batch)
        n += batch.num_rows
        if n >= most:
            yield pa.Table.from_batches(waiting)
            waiting, n = [], 0
    if waiting:
        yield pa.Table.from_batches(waiting)


def _tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts in a row, and how many each text has."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = split.flatten()
    offsets = split.offsets.to_numpy()
    filled = pc.not_equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    there = np.concatenate([[0], np.cumsum(filled)])
    return words.filter(pa.array(filled, pa.bool_())), np.diff(there[offsets - offsets[0]])


def _groups(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches joined to about ``GROUP_BYTES``."""
    waiting, size = [], 0
    for batch in batches(iterator):
        waiting.append(batch)
        size += batch.nbytes
        if size >= GROUP_BYTES:
            yield pa.Table.from_batches(waiting).combine_chunks()
            waiting, size = [], 0
    if waiting:
        yield pa.Table.from_batches(waiting).combine_chunks()


def _texts(table: pa.Table) -> pa.Array:
    column = table.column("text")
    return column.chunk(0) if column.num_chunks else pa.array([], pa.string())


def word_counts(rows: DataFrame) -> DataFrame:
    """``word, c`` of all words and the end, with their counts in training rows; ``rows`` has ``text, held_out``."""

    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(iterator):
            words, sizes = _tokens(_texts(group))
            train = ~group.column("held_out").to_numpy()
            coded = words.dictionary_encode()
            weights = np.repeat(train, sizes).astype(np.float64)
            counts = np.bincount(coded.indices.to_numpy(), weights, len(coded.dictionary)).astype(np.int64)
            found = pa.concat_arrays([coded.dictionary.cast(pa.binary()), pa.array([END], pa.binary())])
            table = pa.table([found, pa.array(np.append(counts, int(train.sum())))], names=["word", "c"])
            yield from table.to_batches(max_chunksize=50_000)

    counted = rows.select("text", "held_out").mapInArrow(run, "word binary, c long")
    return stored(counted.groupBy("word").agg(F.sum("c").alias("c")), "word-counts")


def fit_scores(counts: DataFrame, path: str, rounds: int = ROUNDS) -> np.ndarray:
    """Piece scores after some rounds of expectation maximisation, each over all distinct training words.

    What reaches the driver is a number per piece of the vocabulary, whatever the corpus.
    """
    pieces = read_pieces(path)
    scores = rank_scores(len(pieces))
    spark = counts.sparkSession
    trained = counts.where((F.col("c") > 0) & (F.col("word") != F.lit(END))).select("word")
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(scores)

        def run(iterator: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            lattice, total = None, None
            for batch in _word_groups(iterator):
                lattice = lattice or Lattice(read_pieces(path), shared.value)
                found = lattice.expected_counts([SPACE + w for w in batch.column(0).to_pylist()])
                total = found if total is None else total + found
            if total is not None:
                there = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["piece", "n"])

        expected = trained.mapInArrow(run, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n"))
        weights = np.full(len(pieces), PRIOR)
        for piece, n in expected.collect():
            weights[piece] += n
        scores = np.log(weights / weights.sum())
    return scores


def word_scores(counts: DataFrame, scores: np.ndarray, path: str, n: int, v: int) -> DataFrame:
    """``word, c, base, score``: log10 of the add-one and of the lattice probability of every word."""
    shared = counts.sparkSession.sparkContext.broadcast(scores)

    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = None
        for batch in _word_groups(iterator):
            lattice = lattice or Lattice(read_pieces(path), shared.value)
            words = batch.column(0).to_pylist()
            c = batch.column(1).to_numpy().astype(np.float64)
            subword = lattice.log_probability([SPACE + w for w in words])
            is_end = np.array([w == END for w in words], bool)
            if n + v:
                with np.errstate(divide="ignore"):
                    score = np.logaddexp(np.log(c), math.log(max(v, 1)) + np.where(is_end, -np.inf, subword))
                score -= math.log(n + v)
            else:
                score = np.where(is_end, 0.0, subword)
            base = np.log10((c + 1) / (n + v + 1))
            columns = [batch.column(0), batch.column(1), pa.array(base), pa.array(score / math.log(10))]
            yield from pa.table(columns, names=["word", "c", "base", "score"]).to_batches()

    return stored(counts.mapInArrow(run, "word binary, c long, base double, score double"), "word-scores")


_PARTIAL = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, word binary, times long"
)


def score(documents: DataFrame, path: str, held_out: str = "held_out", hot_words: int = HOT_WORDS) -> DataFrame:
    """Scores of every row of ``doc_id, text`` and a boolean column that is true for rows not to learn from.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col(held_out).alias("held_out"))
    counts = word_counts(rows)
    n, v = counts.where("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    scored = word_scores(counts, fit_scores(counts, path), path, n, v)
    discard(counts)
    is_end = F.col("word") == F.lit(END)
    short = scored.where(~is_end & (F.octet_length("word") <= HOT_WORD_BYTES))
    # The end is a token of every text, so it is always among the hot ones.
    ranked = short.orderBy(F.desc("c"), "word").limit(hot_words).unionByName(scored.where(is_end))
    hot = {bytes(w): (c > 0, b, s) for w, c, b, s in map(tuple, ranked.collect())}
    shared = spark.sparkContext.broadcast(hot)

    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known_words = shared.value
        end = known_words.get(END, (False, 0.0, 0.0))  # none in an empty table
        first = TaskContext.get().partitionId() << 33
        for group in _groups(iterator):
            words, sizes = _tokens(_texts(group))
            coded = words.dictionary_encode()
            vocabulary = coded.dictionary.cast(pa.binary())
            found = [known_words.get(w) for w in vocabulary.to_pylist()]
            cold = np.array([f is None for f in found], bool)
            values = np.array([f or (0, 0.0, 0.0) for f in found], np.float64).reshape(-1, 3)
            codes = coded.indices.to_numpy()
            doc = np.repeat(np.arange(len(sizes)), sizes)
            sums = [np.bincount(doc, values[codes, k], len(sizes)) for k in range(3)]
            number = pa.array(first + np.arange(len(sizes)))
            nulls = pa.nulls(len(sizes), pa.binary()), pa.nulls(len(sizes), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [number, group.column("doc_id").combine_chunks(), group.column("held_out").combine_chunks(),
                 pa.array(sizes + 1), pa.array(sums[0].astype(np.int64) + int(end[0])), pa.array(sums[1] + end[1]),
                 pa.array(sums[2] + end[2]), *nulls],
                [x.split()[0] for x in _PARTIAL.split(", ")],
            )
            # Words that are not hot, once per document with their number of times.
            there = cold[codes]
            pairs, times = np.unique(doc[there] * np.int64(len(found) or 1) + codes[there], return_counts=True)
            for low in range(0, len(pairs), 100_000):
                some = pairs[low : low + 100_000]
                m = len(some)
                of, word = np.divmod(some, len(found))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first + of), pa.nulls(m, pa.int64()), pa.nulls(m, pa.bool_()), pa.nulls(m, pa.int64()),
                     pa.nulls(m, pa.int64()), pa.nulls(m, pa.float64()), pa.nulls(m, pa.float64()),
                     vocabulary.take(pa.array(word)), pa.array(times[low : low + 100_000])],
                    [x.split()[0] for x in _PARTIAL.split(", ")],
                )
            first += len(sizes)

    partial = stored(rows.mapInArrow(run, _PARTIAL), "partial-scores")
    cold = (
        partial.where("word is not null")
        .select("row", "word", "times")
        .join(scored.hint("merge"), "word")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("more_known"),
            F.sum(F.col("base") * F.col("times")).alias("more_base"),
            F.sum(F.col("score") * F.col("times")).alias("more_score"),
        )
    )
    heads = partial.where("word is null").drop("word", "times")
    return heads.join(cold, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )
