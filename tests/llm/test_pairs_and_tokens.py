import hashlib
import itertools
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import xxhash
from llm.helpers import documents, frame, prose, same_rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postlode.llm import golay, induced_sort, packing, pfor, phrase_index, simhash, suffix_dedup
from postlode.llm.components import components
from postlode.llm.tokens import ChunkEncoder

BYTES, LOWER = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def library(path: str) -> Tokenizer:
    found = Tokenizer.from_file(path)
    found.encode_special_tokens = True
    return found


def ids_of(path: str, text: str | None) -> list[int]:
    return [*library(path).encode(text or "", add_special_tokens=False).ids, 1]


def crc(ids: list[int]) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


ODD_TEXTS = [
    None, "", " ", "\n", "\n\n a  b\t c d　x", "don't 's  \r\n x\x1c y\x85z  ", "a" * 900 + " " + "|" * 300, "é é ΑΣ ς",
    "​ zero ﻿ bom 😀😀 ok  ", "tab\tsep\t\tq \n", "<|endoftext|> hi <|startoftext|>x", "a\n\n\nb", "a\n", "\na", " lead",
]


class TestTokens:
    @pytest.mark.parametrize(("path", "keeps"), [(BYTES, True), (LOWER, False)])
    def test_chunks_give_the_ids_of_whole_texts(self, path, keeps):
        texts = ODD_TEXTS + [t for _, t in documents()] + ODD_TEXTS
        found = [ids.tolist() for ids, _ in ChunkEncoder(path, keeps).encode(pa.array(texts, pa.string()))]
        assert found == [ids_of(path, t)[:-1] for t in texts]

    def test_forgetting_changes_nothing(self, monkeypatch):
        encoder = ChunkEncoder(BYTES, True)
        for names, value in (("MEMORY", 20), ("KEPT", 7)):
            monkeypatch.setattr(f"postlode.llm.tokens.{names}", value)
        for _ in range(3):
            for i in range(6):
                (found, _), = encoder.encode(pa.array([prose(i, 50)]))
                assert found.tolist() == ids_of(BYTES, prose(i, 50))[:-1]


class TestBlocks:
    @pytest.mark.parametrize("n", [1, 5, 4096])
    @pytest.mark.parametrize("top", [0, 1, 200, 65_535, 2**32 - 1])
    def test_round_trip(self, n, top):
        rng = np.random.default_rng(n)
        values = rng.integers(0, 100, n).astype(np.uint32)
        values[rng.integers(0, n, max(1, n // 50))] = top
        assert pfor.unpack_block(b"xyz" + pfor.pack_block(values), 3).tolist() == values.tolist()

    def test_files_match_brute_force(self, spark):
        rows = [*documents(), *[(500 + i, t) for i, t in enumerate(ODD_TEXTS)]]
        manifest = pfor.write_tokens(frame(spark, rows, clashing=True), LOWER)
        found = pfor.read_tokens(manifest).collect()
        start, expected = 0, []
        for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
            ids = ids_of(LOWER, t)
            expected.append((i, start, len(ids), crc(ids)))
            start += len(ids)
        same_rows(found, expected)
        file = manifest.first().file
        reader = pfor.Reader(file)
        for place, (_, _, ids) in enumerate(pfor.Reader(file).documents(blocks=1)):
            assert reader.ids(place).tolist() == ids.tolist()

    def test_empty_table(self, spark):
        assert pfor.read_tokens(pfor.write_tokens(frame(spark, []), LOWER)).count() == 0


class TestPacking:
    def test_cuts_are_the_cheapest(self):
        rng = np.random.default_rng(2)
        for _ in range(200):
            ends = np.cumsum(rng.integers(1, 5, rng.integers(1, 9)))
            penalties, size = rng.integers(0, 4, len(ends)), 6
            penalties[-1] = 0

            def cost(cuts, ends=ends, penalties=penalties, size=size):
                at = [0, *(int(ends[c]) for c in cuts)]
                if any(b - a > size for a, b in itertools.pairwise(at)):
                    return 1 << 30
                return sum(size - b + a for a, b in itertools.pairwise(at)) + sum(int(penalties[c]) for c in cuts)

            last = len(ends) - 1
            ways = [[*w, last] for k in range(last + 1) for w in itertools.combinations(range(last), k)]
            assert cost(packing.best_cuts(ends, penalties, size)) == min(map(cost, ways))

    def test_pieces_hold_each_id_once(self, spark):
        rows = [*documents(), *[(500 + i, t) for i, t in enumerate(ODD_TEXTS)], (900, prose(3, 4000))]
        found = packing.pack(frame(spark, rows, clashing=True), BYTES).collect()
        wanted = defaultdict(list)
        for i, t in rows:
            wanted[i].append(ids_of(BYTES, t))
        sequences = defaultdict(list)
        for r in found:
            sequences[r.sequence_id].append(r)
            assert r.length == len(r.ids) // 4 and r.ids_crc32 == zlib.crc32(r.ids)
        rebuilt = defaultdict(list)
        for _, pieces in sorted(sequences.items()):
            pieces.sort(key=lambda r: r.offset)
            assert [p.offset for p in pieces] == [0, *itertools.accumulate(p.length for p in pieces)][:-1]
            assert sum(p.length for p in pieces) <= 2048
            for p in pieces:
                if p.start == 0:
                    rebuilt[p.doc_id].append([])
                rebuilt[p.doc_id][-1] += np.frombuffer(p.ids, "<u4").tolist()
                assert p.doc_tokens in {len(x) for x in wanted[p.doc_id]}
        assert {k: sorted(v) for k, v in rebuilt.items()} == {k: sorted(v) for k, v in wanted.items()}

    def test_little_padding(self, spark):
        rows = [(i, prose(i, 300)) for i in range(200)]
        lengths = defaultdict(int)
        for r in packing.pack(frame(spark, rows).coalesce(1), BYTES).collect():
            lengths[r.sequence_id] += r.length
        full = sorted(lengths.values())[4:]  # each partition's last window may be short
        assert sum(2048 - n for n in full) / (2048 * len(full)) < 0.01

    def test_empty_table(self, spark):
        assert packing.pack(frame(spark, []), BYTES).count() == 0


def test_golay_code_is_perfect_and_neighbours_share_an_index():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 1 << 22, 300)
    near = golay.nearby(words, 22)
    for bits in itertools.chain([()], itertools.combinations(range(22), 1), itertools.islice(itertools.combinations(range(22), 2), 0, None, 9)):
        other = golay.nearby(words ^ sum(1 << b for b in bits), 22)
        shared = (near[:, :, None] == other[:, None, :]) & (near[:, :, None] >= 0)
        assert shared.any(axis=(1, 2)).all()


def brute_prints(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    bits = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(shingles))


class TestSimHash:
    def test_fingerprints_and_groups_match_brute_force(self, spark):
        rows = documents()
        rows += [(600 + i, prose(1, 400).replace("stone", f"stone{i}", 1)) for i in range(25)]
        found = simhash.near_duplicates(frame(spark, rows, clashing=True)).collect()
        prints = [(i, brute_prints(t)) for i, t in rows]
        ids = sorted({i for i, _ in prints if i is not None})
        parent = {i: i for i in ids}

        def root(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for (a, x), (b, y) in itertools.combinations([p for p in prints if p[0] is not None], 2):
            if (x ^ y).bit_count() <= 4 and root(a) != root(b):
                parent[max(root(a), root(b))] = min(root(a), root(b))
        same_rows(found, [(i, f"{x:016x}", None if i is None else root(i)) for i, x in prints])

    def test_one_of_each_group_stays(self, spark):
        rows = documents()
        kept = simhash.one_per_group(frame(spark, rows, clashing=True))
        assert kept.columns == frame(spark, [], clashing=True).columns
        found = [r.doc_id for r in kept.collect()]
        named = [i for i in found if i is not None]
        assert len(named) == len(set(named)) and 3 in named and not {30, 31} & set(named)
        assert found.count(None) == sum(i is None for i, _ in rows)

    def test_which_row_of_an_id_stays_is_fixed(self, spark):
        first, other = prose(1, 80), prose(2, 80)
        rows = [(1, first, "b"), (3, first, "z"), (3, other, "d"), (3, other, "c"), (4, other, "a"), (5, None, None)]
        shape = "doc_id long, text string, note string"
        for turn in (rows, rows[::-1]):
            kept = simhash.one_per_group(spark.createDataFrame(turn, shape).repartition(3)).collect()
            # The text of 3 that is a copy of 1 goes, though 3 is another group's smallest id.
            same_rows(kept, [(1, first, "b"), (3, other, "c"), (5, None, None)])

    def test_random_links_are_all_found(self, spark):
        rng = np.random.default_rng(5)
        base = rng.integers(-(2**63), 2**63, 400)
        rows = []
        for i, fp in enumerate(base.tolist()):
            rows.append((2 * i, fp))
            flipped = fp & (2**64 - 1)
            for b in rng.choice(64, int(rng.integers(1, 6)), replace=False):
                flipped ^= 1 << int(b)
            rows.append((2 * i + 1, flipped - 2**64 if flipped >= 2**63 else flipped))
        groups = {r.fp: r.component for r in simhash.near_groups(spark.createDataFrame(rows, "doc_id long, fp long")).collect()}
        for (a, x), (_, y) in zip(rows[::2], rows[1::2], strict=True):
            linked = ((x ^ y) & (2**64 - 1)).bit_count() <= 4
            assert (groups[x] == groups[y] == a) == linked

    def test_empty_table(self, spark):
        assert simhash.near_duplicates(frame(spark, [])).count() == 0

    def test_components(self, spark):
        links = [(i, i + 1) for i in range(40)] + [(100, 60), (60, 70), (5, 5), (None, 3)]
        found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
        assert found == {**{i: 0 for i in range(41)}, 60: 60, 70: 60, 100: 60}


def brute_hits(rows: list[tuple], items: list[tuple], width: int) -> list[tuple]:
    windows = defaultdict(set)
    for item, text in items:
        words = phrase_index.words_of((text or "").encode())
        for i in range(max(1, len(words) - width + 1) if words and item is not None else 0):
            windows[tuple(words[i : i + width])].add(item)
    out = []
    for doc, text in rows:
        words, hit, found = phrase_index.words_of((text or "").encode()), set(), set()
        for window, who in windows.items():
            for i in range(len(words) - len(window) + 1):
                if tuple(words[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    found |= who
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((doc, len(words), len(hit), len(found), digest, bool(hit)))
    return out


class TestPhraseIndex:
    ITEMS = [
        (1, prose(2, 40)), (2, " ".join(prose(5, 90).split()[20:45])), (3, "Quiet harbour"), (4, "x"), (5, None), (6, ""), (None, "the"),
        (7, " ".join(prose(2, 66).upper().split()[5:30])), (8, prose(2, 40)), (9, "é" * 60),
    ]

    @pytest.mark.parametrize(("block", "segment"), [(200_000, 2_000_000), (2, 100)])  # one block, over 50 blocks
    def test_matches_brute_force(self, spark, monkeypatch, block, segment):
        monkeypatch.setattr(phrase_index, "WINDOWS_PER_BLOCK", block)
        monkeypatch.setattr(phrase_index.build_index, "__defaults__", (segment,))
        rows = documents()
        items = spark.createDataFrame([(*i, "t") for i in self.ITEMS], "item_id long, text string, token string")
        found = phrase_index.contamination(frame(spark, rows, clashing=True), items).collect()
        same_rows(found, brute_hits(rows, self.ITEMS, 10))

    def test_proximity(self, spark):
        rows = [(1, "a x x b y"), (2, "b x x x x a"), (3, "a"), (4, "b a c a b")]
        index = phrase_index.build_index(frame(spark, rows))
        queries = spark.createDataFrame([(1, [b"a", b"b"])], "item_id long, terms array<binary>")
        found = {(r.doc_id, r.pos) for r in phrase_index.proximity_matches(index, queries, 3).collect()}
        assert {d for d, _ in found} == {1, 4}
        exact = phrase_index.phrase_matches(index, queries.selectExpr("item_id", "reverse(terms) as terms")).collect()
        assert [(r.doc_id, r.pos) for r in exact] == [(4, 0)]

    def test_clean_documents(self, spark):
        rows = documents()
        items = spark.createDataFrame([(1, prose(2, 40)), (2, prose(7, 60))], "item_id long, text string")
        kept = phrase_index.clean_documents(frame(spark, rows, clashing=True), items)
        bad = [r[0] for r in brute_hits(rows, [(1, prose(2, 40)), (2, prose(7, 60))], 10) if r[-1]]
        assert kept.columns == frame(spark, [], clashing=True).columns
        assert None in bad and kept.count() == len(rows) - len(bad)
        assert kept.where("doc_id is null and text is null").count() == 1

    def test_a_clean_row_stays_beside_a_contaminated_one_of_its_id(self, spark):
        items = spark.createDataFrame([(1, prose(2, 40))], "item_id long, text string")
        rows = [(5, prose(2, 40)), (5, "quite clean"), (None, prose(2, 40)), (None, "clean too"), (5, None)]
        kept = phrase_index.clean_documents(frame(spark, rows), items).collect()
        same_rows(kept, [(5, "quite clean"), (None, "clean too"), (5, None)])

    def test_runs_join_spans_that_touch_or_nest(self):
        spans = np.array([[4, 9], [0, 3], [3, 4], [20, 30], [21, 22], [40, 41]])
        assert phrase_index._runs(spans[:, 0], spans[:, 1]).tolist() == [[0, 9], [20, 30], [40, 41]]

    def test_windows_stay_on_the_driver_a_block_at_a_time(self, spark, monkeypatch):
        monkeypatch.setattr(phrase_index, "WINDOWS_PER_BLOCK", 10)
        sizes = []
        index = phrase_index.build_index(frame(spark, documents()))
        windows = phrase_index.windows_of(spark.createDataFrame(self.ITEMS, "item_id long, text string"))
        broadcast = spark.sparkContext.broadcast

        def counted(value):
            sizes.append(sum(map(len, value.values())))
            return broadcast(value)

        monkeypatch.setattr(spark.sparkContext, "broadcast", counted)
        many = phrase_index.phrase_matches(index, windows)
        assert len(sizes) > 5 and max(sizes) <= 30 and sum(sizes) == windows.distinct().count()
        monkeypatch.setattr(phrase_index, "WINDOWS_PER_BLOCK", 10_000)
        same_rows(many.collect(), phrase_index.phrase_matches(index, windows).collect())

    def test_empty_tables(self, spark):
        none = spark.createDataFrame([], "item_id long, text string")
        assert phrase_index.contamination(frame(spark, []), none).count() == 0
        assert phrase_index.contamination(frame(spark, documents()), none).where("contaminated").count() == 0


def brute_spans(rows: list[tuple]) -> list[tuple]:
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    first: dict[bytes, int] = {}
    big = 1 << 62
    for i, t in order:
        data = (t or "").encode()
        for p in range(len(data) - 49):
            first.setdefault(data[p : p + 50], big if i is None else i)
    out = []
    for i, t in rows:
        data, own = (t or "").encode(), big if i is None else i
        gone = bytearray(len(data))
        for p in range(len(data) - 49):
            if first[data[p : p + 50]] < own:
                gone[p : p + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(g and (not p or not gone[p - 1]) for p, g in enumerate(gone))
        out.append((i, len(data), sum(gone), int(spans), hashlib.sha256(kept).hexdigest()))
    return out


class TestSuffixDedup:
    @pytest.mark.parametrize(("group", "part"), [(3 << 20, 1 << 20), (2000, 700)])
    def test_matches_brute_force(self, spark, monkeypatch, group, part):
        monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", group)
        monkeypatch.setattr(suffix_dedup, "SLICE", part)
        text = prose(8, 300)
        rows = [*documents(), (700, text[100:400]), (701, "zz" + text[300:700] + text[100:160]), (702, text[100:149]), (703, text[:50])]
        found = suffix_dedup.digests(frame(spark, rows, clashing=True).repartition(3)).collect()
        same_rows(found, brute_spans(rows))

    def test_texts_without_repeats(self, spark):
        rows = [(1, prose(1, 60)), (2, "before " + prose(1, 60) + " after")]
        found = {r.doc_id: r.text for r in suffix_dedup.without_repeats(frame(spark, rows)).collect()}
        assert found == {1: prose(1, 60), 2: "before  after"}

    def test_empty_table(self, spark):
        assert suffix_dedup.digests(frame(spark, [])).count() == 0

    @staticmethod
    def strings(spark, rows: list[tuple], shards: int) -> list[pa.Table]:
        """What comes to each shard, made in this process."""
        groups = suffix_dedup._grouped(frame(spark, rows).repartition(3)).toArrow().combine_chunks()
        found = pa.Table.from_batches(suffix_dedup._hash_rows(shards)(iter(groups.to_batches())))
        parts = [found.filter(pc.equal(found["shard"], k)) for k in set(found["shard"].to_pylist())]
        shared = pa.concat_tables([suffix_dedup._shared_codes(p) for p in parts]).to_pylist()
        marked = [g | {"listed": [x for x in shared if x["grp"] == g["grp"]]} for g in groups.to_pylist()]
        found = pa.Table.from_batches(suffix_dedup._candidates(shards)(iter([pa.RecordBatch.from_pylist(marked)])))
        return [found.filter(pc.equal(found["shard"], k)) for k in range(shards)]

    @staticmethod
    def sorted_sizes(monkeypatch) -> list[int]:
        sizes = []
        sort = suffix_dedup.suffix_array
        monkeypatch.setattr(suffix_dedup, "suffix_array", lambda s, *more: sizes.append(len(s)) or sort(s, *more))
        return sizes

    def test_strings_that_can_match_no_other_are_not_sorted(self, spark, monkeypatch):
        sizes = self.sorted_sizes(monkeypatch)
        rng = np.random.default_rng(1)
        text = "".join(map(chr, rng.integers(97, 123, 20_000)))
        for table in self.strings(spark, [(1, text), (2, text), (3, text[5000:])], 2):
            assert suffix_dedup._decide_shard(table).num_rows == table.num_rows > 1
        assert sum(sizes) < 2000

    def test_a_shard_is_sorted_in_parts(self, spark, monkeypatch):
        rows = [*documents(), (700, prose(8, 300)), (701, "zz" + prose(8, 300)[90:]), (None, prose(8, 300)[7:900])]
        tables = self.strings(spark, rows, 2)
        whole = [suffix_dedup._decide_shard(t) for t in tables]
        sizes = self.sorted_sizes(monkeypatch)
        monkeypatch.setattr(suffix_dedup, "SORTED", 200, raising=False)
        assert [suffix_dedup._decide_shard(t) for t in tables] == whole
        assert len(sizes) > 4

    def test_few_rows_go_between_groups_and_shards(self, spark, monkeypatch):
        rows = [(i, prose(i, 400)) for i in (*range(60), *range(30))]
        total = suffix_dedup._grouped(frame(spark, rows)).agg(F.sum(F.octet_length("body"))).first()[0]
        width = int(spark.conf.get("spark.sql.shuffle.partitions"))
        monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", total // (3 * width))
        # One more for the places of the group's runs.
        assert max(len(r.listed) for r in suffix_dedup._results(frame(spark, rows)).collect()) <= 4 * width + 1

    @pytest.mark.parametrize("alphabet", [5, 300, 70_000])
    def test_order_by_ranks(self, alphabet):
        rng = np.random.default_rng(alphabet)
        for n, depth in ((1, 1), (2, 5), (400, 400), (3000, 7), (3000, 40)):
            data = rng.integers(0, alphabet, n).astype(np.int32)
            data[n // 2 : n // 2 + n // 4] = data[: n // 4]
            found = induced_sort._by_doubling(data, depth).tolist()
            keys = [tuple(data[i : i + depth].tolist()) for i in found]
            assert keys == sorted(keys) and sorted(found) == list(range(n))

    @pytest.mark.parametrize(("letters", "depth"), [(2, None), (4, 50), (40, 50), (256, None)])
    def test_hundred_thousand_symbols(self, letters, depth):
        rng = np.random.default_rng(letters)
        data = rng.integers(1, letters + 1, 100_000).astype(np.uint16)
        data[60_000:60_400] = data[10_000:10_400]  # a long repeat
        data[::997] = 0
        raw = data.astype(">u2").tobytes()
        width = 2 * (depth or 600)
        found = induced_sort.suffix_array(data, letters + 1, depth)
        keys = [raw[2 * i : 2 * i + width] for i in found.tolist()]
        assert keys == sorted(keys) and sorted(found.tolist()) == list(range(100_000))
        common = induced_sort.permuted_prefixes(data, found, 50)
        for place in rng.integers(1, 100_000, 500).tolist():
            a, b, k = int(found[place]), int(found[place - 1]), 0
            while k < 50 and max(a, b) + k < 100_000 and data[a + k] == data[b + k] != 0:
                k += 1
            assert common[a] == k
