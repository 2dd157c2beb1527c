import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from llm.helpers import documents, frame, prose, same_rows
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from postlode.llm import diagonal_align
from postlode.llm.diagonal_align import diagonal_runs, group_ends
from postlode.llm.tokens import byte_alphabet

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def tokens(text: str) -> tuple[list[tuple], list[tuple]] | None:
    """``id, bytes`` of both libraries' whole-text encodings; None if the bytes are not the text's."""
    library = Tokenizer.from_file(BYTES)
    library.encode_special_tokens = True
    model = SentencePieceProcessor(model_file=PIECES)
    alphabet = byte_alphabet()
    a = library.encode(" " + text, add_special_tokens=False)
    first = [(i, bytes(alphabet[c] for c in t)) for i, t in zip(a.ids, a.tokens, strict=True)]
    second = []
    for i in model.encode(text):
        piece = model.id_to_piece(i)
        byte = bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()
        second.append((i, byte))
    whole = (" " + text).encode()
    return (first, second) if all(b"".join(x[1] for x in side) == whole for side in (first, second)) else None


def ranges(side: list[tuple]) -> list[tuple]:
    ends = np.cumsum([len(b) for _, b in side]).tolist()
    return [(i, e) for (i, _), e in zip(side, ends, strict=True)]


def brute(rows: list[tuple]) -> tuple[list[tuple], Counter]:
    """Sets of offsets and all pairs of occurrences, document by document."""
    each, counts = [], Counter()
    for doc_id, text in rows:
        both = tokens(text) if text else None
        if both is None:
            each.append((doc_id, 0, 0, [], ""))
            continue
        a, b = ranges(both[0]), ranges(both[1])
        cuts = sorted({e for _, e in a} & {e for _, e in b})
        links = [(i, k) for i, e in a for k, f in b if e == f] if len(a) < 400 else None
        if links is None:
            of_b = dict((e, k) for k, e in b)
            links = [(i, of_b[e]) for i, e in a if e in of_b]
        counts.update(links)
        written, low = [], 0
        for cut in cuts:
            sides = (",".join(str(i) for i, e in side if low < e <= cut) for side in (a, b)) if len(a) < 400 else ("", "")
            written.append("|".join(sides))
            low = cut
        each.append((doc_id, len(a), len(b), links, ";".join(written)))
    highest = Counter()
    for (_, k), n in counts.items():
        highest[k] = max(highest[k], n)
    result = []
    for doc_id, n_a, n_b, links, written in each:
        best = sum(counts[link] == highest[link[1]] for link in links)
        sha = hashlib.sha256(written.encode()).hexdigest() if written and n_a < 400 else None if written else ""
        result.append((doc_id, n_a, n_b, len(links), len(links), best, sum(counts[x] for x in links), sha))
    return result, counts


def rows() -> list[tuple]:
    odd = [
        "<s> hi </s> <unk>", "<|endoftext|> x", "▁ sign", "two  spaces   three", "\n\n a\tb\r\nc", "é ü ß 東京 😀😀 ﬁ", " lead", "trail ",
        "x\x00y\x1c\x85 z", "1234567 8.9e10", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "ａｂｃ　ｄ", "﻿bom", "a" * 300,
    ]
    return [*documents(), *[(700 + i, t) for i, t in enumerate(odd)], (700, "again the same id"), (None, "no id")]


def test_runs_are_the_common_ends():
    rng = random.Random(1)
    for trial in range(400):
        n = rng.choice([1, 2, 5, 40, 300])
        chance = rng.choice([0.0, 0.05, 0.5])
        ends = sorted(rng.sample(range(1, 2000), n))
        a, b = ([e for e in ends[:-1] if rng.random() >= chance] + ends[-1:] for _ in range(2))
        if trial % 3 == 0:
            b = sorted({*b, *rng.sample(range(1, ends[-1] + 1), min(3, ends[-1]))})
        last_a, last_b = group_ends(np.array(a), np.array(b))
        assert [a[i] for i in last_a] == sorted(set(a) & set(b)) == [b[i] for i in last_b]


def test_one_run_where_all_ends_agree():
    ends = np.arange(1, 100_001)
    assert [x.tolist() for x in diagonal_runs(ends, ends)] == [[0], [0], [100_000]]
    one_more = np.sort(np.append(2 * ends, 100_001))
    starts_a, starts_b, lengths = diagonal_runs(2 * ends, one_more)
    assert (starts_b - starts_a).tolist() == [0, 1] and lengths.tolist() == [50_000, 50_000]


@pytest.mark.parametrize("chunk_bytes", [1, 16 << 20])
def test_equals_brute_force(spark, monkeypatch, chunk_bytes):
    monkeypatch.setattr(diagonal_align, "CHUNK_BYTES", chunk_bytes)
    data = rows()
    table = spark.createDataFrame(
        [(*r, 1, 2, "p", 3) for r in data], "doc_id long, text string, chunk long, pair long, pairs string, at int"
    )
    found = [tuple(r) for r in diagonal_align.digests(table, BYTES, PIECES).collect()]
    expected, _ = brute(data)
    long = {r[0] for r in expected if r[-1] is None}
    same_rows([(*r[:-1], None if r[0] in long else r[-1]) for r in found], expected)
    assert sum(r[1] == 0 for r in expected) >= 4 and sum(r[1] > 0 for r in expected) > 30


def test_pair_counts(spark):
    data = rows()
    found = diagonal_align.id_pairs(frame(spark, data), BYTES, PIECES).collect()
    assert {(r.a, r.b): r["count"] for r in found} == brute(data)[1]
    assert {r.b for r in found if r.best} == {r.b for r in found}


def test_groups_hold_the_text(spark):
    data = [(i, t) for i, t in rows() if i is not None and i not in (3, 700)]
    texts = dict(data)
    for r in diagonal_align.groups(frame(spark, data, clashing=True), BYTES, PIECES).collect():
        both = tokens(texts[r.doc_id]) if texts[r.doc_id] else None
        if both is None:
            assert (r.a_ids, r.b_ids, r.ends) == ([], [], [])
            continue
        assert (r.a_ids, r.b_ids) == tuple([i for i, _ in side] for side in both)
        assert (sum(r.a_sizes), sum(r.b_sizes)) == (len(r.a_ids), len(r.b_ids))
        reached = np.cumsum([len(b) for _, b in both[1]])[np.cumsum(r.b_sizes) - 1] - 1
        assert r.ends == reached.tolist() and r.ends[-1] == len(texts[r.doc_id].encode())


def test_empty_table_and_long_text(spark):
    assert diagonal_align.digests(frame(spark, []), BYTES, PIECES).count() == 0
    long = " ".join(prose(i, 400) for i in range(1200))
    assert len(long) > 2_000_000
    (one,) = diagonal_align.digests(frame(spark, [(1, long)]), BYTES, PIECES).collect()
    (other,) = diagonal_align.digests(frame(spark, [(1, long), (2, None)]), BYTES, PIECES).where("doc_id = 1").collect()
    assert one == other and one.n_groups == one.n_links > 300_000
