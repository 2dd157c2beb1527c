import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from llm.helpers import documents, frame, prose, same_rows
from pyspark.sql import functions as F

from postlode.llm import compression, induced_sort, lattice

PIECES = public_tokenizers.path("piece_bpe_32k.model")


class TestLattice:
    def test_forward_sums_all_segmentations(self):
        pieces = [bytes([b]) for b in range(256)] + [b"ab", b"bc", b"abc", b"cab"]
        scores = np.log(np.full(len(pieces), 1 / len(pieces)))
        model = lattice.Lattice(pieces, scores)

        def brute(word: bytes) -> float:
            if not word:
                return 1.0
            return sum(math.exp(scores[i]) * brute(word[len(p) :]) for i, p in enumerate(pieces) if word.startswith(p))

        words = [b"abcab", b"z", b"abc", b"cabcabc", b"\xc3\xa9ab"]
        assert np.allclose(model.log_probability(words), [math.log(brute(w)) for w in words])
        assert np.allclose([model._scalar(w)[-1] for w in words], model.log_probability(words))

    def test_expected_counts_cover_every_byte(self):
        pieces = lattice.read_pieces(PIECES)
        model = lattice.Lattice(pieces, lattice.rank_scores(len(pieces)))
        words = [b"harbour", b"x" * 70, "größe".encode(), b"a"]
        counts = model.expected_counts(words)
        assert np.isclose((counts * np.array([len(p) for p in pieces])).sum(), sum(map(len, words)))

    @pytest.mark.parametrize("hot", [5, 200_000])
    def test_scores_match_brute_force(self, spark, hot):
        rows = documents()
        held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7, F.lit(0)) == 2
        found = lattice.score(frame(spark, rows, clashing=True).withColumn("held_out", held), PIECES, hot_words=hot).collect()

        def tokens(text):
            return [*(text or "").encode().lower().split(), b""]

        def out(i):
            return i is not None and zlib.crc32(str(i).encode()) % 7 == 2

        counts = Counter(w for i, t in rows if not out(i) for w in tokens(t))
        n, v = sum(counts.values()), len(counts)
        expected = []
        for i, t in rows:
            words = tokens(t)
            base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
            expected.append((i, out(i), len(words), sum(w in counts for w in words), n, round(base, 6)))
        same_rows([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found], expected)
        for r in found:
            assert -1e7 < r.score <= 0 and math.isfinite(r.score)
        # A known word is worth at least its share of the mass, so known texts come near the base.
        known = [r for r in found if r.n_known == r.n_tokens and r.n_tokens > 30]
        assert known and all(r.score > r.base_score - r.n_tokens for r in known)

    def test_nothing_to_learn_from(self, spark):
        rows = frame(spark, [(1, "quiet harbour"), (2, None)]).withColumn("held_out", F.lit(True))
        found = {r.doc_id: r for r in lattice.score(rows, PIECES).collect()}
        assert found[2].score == 0 and found[1].score < 0 and found[1].train_tokens == 0

    def test_empty_table(self, spark):
        assert lattice.score(frame(spark, []).withColumn("held_out", F.lit(False)), PIECES).count() == 0


class TestCompression:
    @staticmethod
    def rows() -> list[tuple]:
        good = [(i, prose(i, 60 + i % 90)) for i in range(200)]
        bad = [(1000 + i, " ".join(w.upper() + "!!" for w in prose(i, 60 + i % 90).split())) for i in range(80)]
        return good + bad

    def test_held_out_accuracy(self, spark):
        rows = self.rows()
        train, test = [r for r in rows if r[0] % 5], [r for r in rows if not r[0] % 5]
        labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in train], "doc_id long, label int")
        model = compression.fit(frame(spark, rows), labels)
        found = compression.score(frame(spark, test), model).collect()
        assert all(0 <= r.score <= 1 for r in found)
        assert sum((r.score >= 0.3) == (r.doc_id < 1000) for r in found) / len(found) > 0.95

    @pytest.mark.parametrize("place", ["middle", "end"])
    def test_learns_signs_behind_the_first_lines(self, spark, place):
        def text(i: int, bad: bool) -> str:
            junk = prose(9000 + i, 40)
            junk = " ".join(w.upper() + "!!" for w in junk.split()) if bad else junk
            return f"{prose(i, 70)}\n{junk}" + (f"\n{prose(20_000 + i, 30)}" if place == "middle" else "")

        # More texts a class than the sample takes.
        rows = [(i, text(i, i % 2 == 0)) for i in range(2 * (compression.SAMPLE_ROWS + 200))]
        test = [(100_000 + i, text(100_000 + i, i % 2 == 0)) for i in range(100)]
        labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, label int")
        model = compression.fit(frame(spark, rows), labels)
        found = compression.score(frame(spark, test), model).collect()
        assert sum((r.score >= 0.5) == (r.doc_id % 2 == 1) for r in found) / len(found) > 0.95

    def test_every_text_gives_all_its_parts_alike(self):
        texts = [bytes(100 + j // 40 for j in range(2000)) + b"%d" % i for i in range(1500)]
        taken = Counter(compression._dictionary(texts, 400_000))
        tenths = [sum(taken[100 + j] for j in range(k, k + 5)) for k in range(0, 50, 5)]
        assert max(tenths) < 1.2 * min(tenths)

    @pytest.mark.parametrize("at", [300_000, 1_000_000, 2_500_000, 5_000_000])
    def test_a_passage_counts_wherever_it_stands(self, at):
        def shouted(seed: int, n: int) -> str:
            return " ".join(w.upper() + "!!" for w in prose(seed, n).split())

        sizes = compression.Sizes(prose(1, 5000).encode(), shouted(2, 5000).encode())
        rng = np.random.default_rng(3)
        words = [bytes(rng.integers(97, 123, rng.integers(2, 10)).astype(np.uint8)) for _ in range(5000)]
        filler = b" ".join(words[i] for i in rng.integers(0, len(words), 900_000))[:5_100_000]
        passage = shouted(4, 400).encode()

        def effect(place: int) -> float:
            with_it = filler[:place] + passage + filler[place + len(passage) :]
            return sizes.feature(with_it) - sizes.feature(filler)

        assert effect(0) < 0 and 0.8 < effect(at) / effect(0) < 1.25

    def test_long_bad_texts_are_bad(self, spark):
        rows = self.rows()
        labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in rows], "doc_id long, label int")
        model = compression.fit(frame(spark, rows), labels)
        filler = np.random.default_rng(3).integers(97, 123, 2_500_000).astype(np.uint8).tobytes().decode()
        long = [(1, f"{filler} {prose(5, 40_000)}"), (2, f"{filler} " + " ".join(w.upper() + "!!" for w in prose(5, 40_000).split()))]
        found = {r.doc_id: r.score for r in compression.score(frame(spark, long), model).collect()}
        neutral = compression.score(frame(spark, [(0, "")]), model).first().score
        assert found[2] < min(neutral, 0.3) < found[1]

    def test_odd_rows_and_columns(self, spark):
        rows = self.rows()
        labels = spark.createDataFrame(
            [(i, int(i < 1000)) for i, _ in rows] + [(1, None), (None, 1), (1, 1)], "doc_id long, label int"
        )
        model = compression.fit(frame(spark, [*rows, *documents()], clashing=True), labels)
        odd = frame(spark, documents(), clashing=True)
        scored = compression.score(odd, model, to="_quality")
        assert scored.columns == [*odd.columns, "_quality"]
        assert scored.where("_quality between 0 and 1").count() == odd.count()

    def test_no_labels(self, spark):
        labels = spark.createDataFrame([], "doc_id long, label int")
        model = compression.fit(frame(spark, self.rows()), labels)
        assert {r.score for r in compression.score(frame(spark, documents()), model).collect()} == {0.5}
        assert compression.score(frame(spark, []), model).count() == 0


@pytest.mark.parametrize("alphabet", [2048, 3])
def test_induced_sorting(alphabet, monkeypatch):
    monkeypatch.setattr(induced_sort, "LARGEST_ALPHABET", alphabet)
    rng = np.random.default_rng(4)
    for _ in range(300):
        n, sigma = int(rng.integers(1, 70)), int(rng.integers(1, 6))
        s = rng.integers(0, sigma, n)
        assert induced_sort.suffix_array(s, sigma).tolist() == sorted(range(n), key=lambda i: s[i:].tolist())
