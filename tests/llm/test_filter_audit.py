import re
from itertools import permutations

import pytest
from llm.helpers import documents, prose

from postlode.llm import filter_audit
from postlode.llm.filter_audit import FILTERS, lehmer_rank, removal_intervals


def fails(text: str, doc_id, rows: list[tuple]) -> set[str]:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    same = [i for i, t, *_ in rows if (t or "") == text and i is not None]
    found = {
        "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": re.search(r"[#$%&*|]", text) is not None,
        "E": doc_id is not None and min(same) < doc_id,
    }
    return {k for k, v in found.items() if v}


def brute(rows: list[tuple], labels: list[tuple]) -> dict:
    """Every document through every order of the filters."""
    result = {}
    for part in {r[2] or "" for r in rows}:
        own = [r for r in rows if (r[2] or "") == part]
        failed = [fails(t or "", i, rows) for i, t, *_ in own]
        good = [any(i == d and q == 1 for d, q, _ in labels) if i is not None else False for i, *_ in own]
        toxic = [any(i == d and t == 1 for d, _, t in labels) if i is not None else False for i, *_ in own]
        shapley = dict.fromkeys(FILTERS, 0)
        for order in permutations(FILTERS):
            here = set(range(len(own)))
            for step, f in enumerate(order, 1):
                gone = {k for k in here if f in failed[k]}
                before = {k for k in range(len(own)) if f in failed[k]} - gone
                here -= gone
                shapley[f] += len(gone)
                result[part, "".join(order), step] = [
                    len(here), len(gone), len(before), sum(x == {f} for x in failed),
                    sum(good[k] for k in gone), sum(toxic[k] for k in gone),
                ]
        for (p, order, step), values in result.items():
            if p == part:
                values.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in result.items()}


def rows() -> list[tuple]:
    langs = ["en", "de", None, ""]
    found = [(i, t, langs[k % 4]) for k, (i, t) in enumerate(documents())]
    found += [(200 + i, prose(i, 260).upper() if i % 2 else f"{prose(i, 300)} #", "en") for i in range(6)]
    found += [(300 + i, "same text | here", langs[i % 4]) for i in range(9)]
    return [*found, (400, "Q w " * 400, "de"), (401, None, None), (None, "same text | here", "en"), (300, "same text | here", "de")]


LABELS = [(i, i % 2, i % 3 == 0) for i in range(0, 420, 2)] + [(300, 1, 0), (300, None, None), (None, 1, 1), (999, 1, 1)]


def table(spark, data):
    schema = "doc_id long, text string, lang string, part string, mask int, rank long, first boolean, words string"
    return spark.createDataFrame([(*r, "p", 7, 1, True, "w") for r in data], schema)


def labels(spark, data):
    return spark.createDataFrame([(i, q, None if t is None else int(t)) for i, q, t in data], "doc_id long, quality int, toxic int")


def found(df) -> dict:
    return {(r[0], r[1], r[2]): tuple(r)[3:] for r in df.collect()}


def test_ranks_count_the_orders():
    for n in (1, 3, 5):
        for rank, order in enumerate(permutations(range(n))):
            assert lehmer_rank(order, n) == rank


def test_intervals_hold_each_order_once_a_mask():
    orders = list(permutations(range(5)))
    for mask in range(1, 32):
        steps = [0] * 120
        for _, step, low, high in (x for x in removal_intervals(5) if x[0] == mask):
            for rank in range(low, high):
                assert steps[rank] == 0
                steps[rank] = step
        assert steps == [next(s for s, f in enumerate(o, 1) if mask >> f & 1) for o in orders]


def test_equals_every_document_through_every_order(spark):
    data = rows()
    result = found(filter_audit.audit_documents(table(spark, data), labels(spark, LABELS)))
    assert result == brute(data, LABELS)
    assert len(result) == 3 * 120 * 5


def test_empty_tables(spark):
    none = table(spark, rows()).where("false")
    assert filter_audit.audit_documents(none, labels(spark, LABELS)).count() == 0
    result = found(filter_audit.audit_documents(table(spark, rows()), labels(spark, LABELS).where("false")))
    assert result == brute(rows(), [])


def test_long_text(spark):
    data = [(1, "aB " * 1_000_000, "en"), (2, "aB " * 1_000_000, "en"), (3, " ".join(f"w{i}" for i in range(250)), "en")]
    result = found(filter_audit.audit_documents(table(spark, data), labels(spark, [])))
    assert result["en", "ABCDE", 1][:2] == (3, 0)
    assert result["en", "ABCDE", 2][:2] == (1, 2)
    assert result["en", "ECBAD", 1][:4] == (2, 1, 0, 0)


def test_other_numbers_of_filters(spark):
    masks = spark.createDataFrame([("p", m, m % 2 == 0) for m in (0, 1, 2, 3, 3, 7, 4)], "part string, mask int, w boolean")
    result = found(filter_audit.audit(masks, "XYZ", ["w"]))
    assert result["p", "XYZ", 1] == (3, 4, 0, 1, 0, sum(v[1] for k, v in result.items() if k[1][k[2] - 1] == "X"))
    assert result["p", "ZYX", 3] == (1, 1, 3, 1, 0, result["p", "XYZ", 1][-1])
    with pytest.raises(ValueError, match="ascending"):
        filter_audit.audit(masks, "YX")
