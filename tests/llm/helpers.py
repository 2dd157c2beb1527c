"""Small document tables with the cases every operator must handle."""

from __future__ import annotations

import random

WORDS = "the of and bridge river stone lantern window copper maple signal harbour quiet winter engine yellow".split()


def prose(seed: int, n_words: int) -> str:
    rng = random.Random(seed)
    words = [rng.choice(WORDS) + rng.choice(["", "", "", ",", "s", "ed"]) for _ in range(n_words)]
    return " ".join(w + ("." if i % 11 == 10 else "") + ("\n" if i % 37 == 36 else "") for i, w in enumerate(words)) + "."


SHARED_LINE = "This very same line of more than forty characters stands in many documents."
ODD = [
    (100, None), (101, ""), (102, " \t\n "), (103, "one"), (104, "é" * 60 + " x y"),
    (105, "word " * 3000), (106, "x" * 5000), (None, prose(7, 60)), (None, None), (107, "a\n\n\nb\r\n  c\x1cd\x00e"),
]


def documents() -> list[tuple]:
    rows = [(i, prose(i, 40 + 13 * i)) for i in range(12)]
    rows += [(20 + i, f"{prose(50 + i, 30)}\n{SHARED_LINE}\n{prose(90 + i, 30)}") for i in range(6)]
    rows += [(30, rows[3][1]), (31, rows[3][1]), (3, rows[3][1])]  # copies, one of them under the same id
    rows += [(40, rows[4][1].replace("bridge", "tower", 1)), *ODD]
    return rows


# Extra columns whose names operators use inside.
CLASHING = "doc_id long, text string, h string, pos int, of long, keep string, node long, segment string, _score double"


def frame(spark, rows: list[tuple], clashing: bool = False):
    if not clashing:
        return spark.createDataFrame(rows, "doc_id long, text string")
    return spark.createDataFrame([(*r, "h", 1, 2, "k", 3, "s", 0.5) for r in rows], CLASHING)


def key(row: tuple) -> tuple:
    return tuple((x is not None, x if x is not None else 0) for x in row)


def same_rows(found, expected) -> None:
    assert sorted(map(tuple, found), key=key) == sorted(map(tuple, expected), key=key)
