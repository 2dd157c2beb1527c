import random
import re

import numpy as np
import pyarrow as pa
import pytest
from llm.helpers import documents, frame, prose, same_rows

from postlode.llm import bbit_minhash
from postlode.llm.bbit_minhash import MINIMA


def shingles(text: str | None, k: int) -> frozenset:
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def brute(rows: list[tuple], k: int, percent: int) -> list[tuple]:
    """Every pair of rows; those that share an id are one node if their sets have members."""
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if rows[i][0] is None or rows[j][0] is None or not a or not b:
                continue
            if rows[i][0] == rows[j][0] or 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    result = []
    for i, (doc_id, _) in enumerate(rows):
        reached = [r[0] for j, r in enumerate(rows) if find(j) == find(i) and r[0] is not None]
        component = min(reached) if doc_id is not None else None
        result.append((doc_id, len(sets[i]), component, doc_id is not None and doc_id == component))
    return result


def near_copies() -> list[tuple]:
    """Groups around the limit, a chain of drifting copies, and copies that differ in case and space alone."""
    rng, rows = random.Random(3), documents()
    rows += [(600 + i, prose(600 + i % 3, 120).upper() if i % 2 else "  " + prose(600 + i % 3, 120)) for i in range(9)]
    for base in range(4):
        words = [f"w{rng.randrange(10**6)}" for _ in range(150)]
        for copy in range(12):
            changed = list(words)
            for _ in range(rng.randrange(0, 16)):
                changed[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
            rows.append((1000 + 50 * base + copy, " ".join(changed)))
    words = [f"d{rng.randrange(10**6)}" for _ in range(200)]
    for step in range(40):
        for _ in range(6):
            words[rng.randrange(200)] = f"e{rng.randrange(10**6)}"
        rows.append((2000 - step, " ".join(words)))
    rows += [(1000, rows[-1][1]), (2000, "one other text"), (3000, "one other text")]  # ids with several texts
    rows += [(4000, "a b c d e"), (4001, "a b c d e f"), (4002, "a b c d"), (4003, "solo"), (4004, "SOLO"), (4005, "b")]
    return rows


@pytest.mark.parametrize(("k", "percent"), [(2, 80), (5, 80), (1, 90)])
def test_equals_brute_force(spark, k, percent):
    rows = near_copies()
    random.Random(k).shuffle(rows)
    schema = "doc_id long, text string, node long, comp long, digest string, key long, n long, doc long, bands int"
    table = spark.createDataFrame([(*r, 1, 2, "d", 3, 4, 5, 6) for r in rows], schema)
    found = bbit_minhash.near_duplicates(table, k, percent)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    same_rows(found.collect(), brute(rows, k, percent))


def test_one_group_of_many_near_copies(spark):
    """No key's bucket is paired out: nodes of one group ask for nothing more."""
    rng = random.Random(5)
    words = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(1500):
        changed = list(words)
        for _ in range(3):
            changed[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        rows.append((i + 10, " ".join(changed)))
    rows += [(9000 + i, rows[0][1]) for i in range(500)] + [(5, prose(1, 80))]
    found = bbit_minhash.near_duplicates(frame(spark, rows), 2).collect()
    assert {r.component_id for r in found} == {5, 10}
    assert sum(r.kept for r in found) == 2


def test_empty_table_and_long_texts(spark):
    assert bbit_minhash.near_duplicates(frame(spark, [])).count() == 0
    long = " ".join(f"w{i % 70_001}x{i}" for i in range(300_000))
    rows = [(1, long), (2, long + " more"), (3, long[: len(long) // 2]), (4, None)]
    found = bbit_minhash.near_duplicates(frame(spark, rows), 2).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(1, 1), (2, 1), (3, 3), (4, 4)]


def test_one_per_group_keeps_whole_rows(spark):
    rows = near_copies()
    kept = bbit_minhash.one_per_group(frame(spark, rows, clashing=True), 2).collect()
    expected = [(i, t) for (i, t), r in zip(rows, brute(rows, 2, 80), strict=True) if i is None or r[3]]
    same_rows([(r.doc_id, r.text) for r in kept], expected)


def test_limits_are_checked(spark):
    for bad in ({"percent": 79}, {"percent": 101}, {"shingle_words": 0}):
        with pytest.raises(ValueError):
            bbit_minhash.near_duplicates(frame(spark, []), **bad)


@pytest.mark.parametrize("similarity", [0.0, 0.3, 0.8, 0.95])
def test_estimate_is_corrected_for_chance(spark, similarity):
    rng = np.random.default_rng(1)
    both = round(2 * 2000 * similarity / (1 + similarity))
    found = []
    for _ in range(8):
        a = np.unique(rng.integers(0, 1 << 63, 2000).astype(np.uint64))
        b = np.unique(np.concatenate([a[:both], rng.integers(0, 1 << 63, 2000 - both).astype(np.uint64)]))
        signs = bbit_minhash.signatures(np.stack([bbit_minhash.minima(a), bbit_minhash.minima(b)])).tolist()
        row = spark.createDataFrame([tuple(signs)], "l array<long>, r array<long>")
        found.append(row.select(bbit_minhash.estimate("l", "r")).first()[0])
    assert abs(np.mean(found) - similarity) < 0.04


def test_sets_do_not_depend_on_the_other_texts():
    texts = [t for _, t in near_copies()] + ["x\x1cy z\x85w q", " a\x0bb\x0cc "]
    together = bbit_minhash.shingle_sets(pa.array(texts, pa.string()), 3)
    alone = [bbit_minhash.shingle_sets(pa.array([t], pa.string()), 3)[0] for t in texts]
    assert all((a == b).all() and len(a) == len(shingles(t, 3)) for a, b, t in zip(together, alone, texts, strict=True))
    assert bbit_minhash.minima(together[0][:0]).shape == (MINIMA,)
