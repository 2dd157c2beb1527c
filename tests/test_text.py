import contextlib
import html.entities
import random
import re
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postlode.functions import numbers, text
from postlode.functions.sql import register_sql_functions


def damage(s, times=1):
    for _ in range(times):
        s = s.encode("utf-8").decode("latin-1")
    return s


@pytest.mark.parametrize("original", ["Maceió, ", "Łódź, Polska", "القاهرة", "Engineer — Tools", "大阪"])
@pytest.mark.parametrize("times", [1, 2, 3])
def test_damage_is_undone_up_to_three_layers(one, original, times):
    assert one(text.repair_mojibake("s"), "s string", damage(original, times)) == original


@pytest.mark.parametrize(
    "clean", ["São Luís", "Köln", "Gdańsk, Polska", "الرباط", "京都", "Remote - EU", "", None]
)
def test_clean_text_is_left_alone(one, clean):
    assert one(text.repair_mojibake("s"), "s string", clean) == clean


def test_runs_are_judged_one_by_one(one):
    mixed = "Köln or " + damage("Maceió")
    assert one(text.repair_mojibake("s"), "s string", mixed) == "Köln or Maceió"
    cut = damage("é") + "!" + damage("東")[:2]
    assert one(text.repair_mojibake("s"), "s string", cut) == "é!" + damage("東")[:2]


def by_hand(s):
    """Every run of U+0080 to U+00FF that is valid UTF-8, decoded three times over."""
    for _ in range(3):
        s = re.sub("[\x80-\xff]+", lambda m: decoded(m.group()), s)
    return s


def decoded(run):
    with contextlib.suppress(UnicodeDecodeError):
        return run.encode("latin-1").decode()
    return run


def test_repair_agrees_with_a_search_by_hand(spark):
    texts = st.lists(
        st.text(alphabet=st.characters(codec="utf-8", max_codepoint=0x2FF), max_size=40),
        min_size=20, max_size=60,
    )

    @settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
    @given(texts, st.integers(0, 3))
    def agree(values, times):
        damaged = [damage(v, times) for v in values]
        df = spark.createDataFrame(list(enumerate(damaged)), "i int, s string")
        got = dict(df.select("i", text.repair_mojibake("s")).collect())
        assert got == {i: by_hand(s) for i, s in enumerate(damaged)}

    agree()


def test_clean_text(one):
    assert one(text.clean_text("s"), "s string", " a \t\n b　 c ") == "a b c"
    assert one(text.clean_text("s"), "s string", "a b") == "a b"
    assert one(text.clean_text("s"), "s string", " \n ") is None
    assert one(text.clean_text("s"), "s string", None) is None


@pytest.mark.parametrize(
    "raw, stripped", [("Curitiba, ", "Curitiba"), (", ,\n", ""), ("a, b", "a, b"), ("x, ", "x")]
)
def test_trailing_separators(one, raw, stripped):
    assert one(text.strip_trailing_separators("s"), "s string", raw) == stripped


def test_mojibake_and_script_tests(one):
    assert one(text.is_mojibake("s"), "s string", damage("é"))
    assert not one(text.is_mojibake("s"), "s string", "São Paulo")
    assert one(text.null_if_mojibake("s"), "s string", damage("é")) is None
    assert one(text.null_if_mojibake("s"), "s string", "é") == "é"
    for s, non_latin in [("دبي", True), ("É", True), ("Zürich", False), ("plain", False), ("12", False)]:
        assert one(text.is_non_latin("s"), "s string", s) is non_latin
    assert one(text.is_non_latin("s"), "s string", None) is None


def test_surrogate_key_ignores_case_and_outer_spaces(one):
    keys = {one(text.surrogate_key("s"), "s string", v) for v in ["ACME", "Acme", " acme "]}
    assert len(keys) == 1


def test_references_are_decoded_as_html_has_them(spark):
    rng = random.Random(5)
    names = list(html.entities.html5)
    bits = ["&", "#", "x", ";", "lt", "notit", " ", "é", "0", "38", "x80", "xD800", "1114112", "9" * 12, "13", "\n", "\\", "'"]
    parts = [lambda: rng.choice(bits), lambda: "&" + rng.choice(names), lambda: f"&#{rng.randrange(70000)}" + rng.choice(["", ";"])]
    rows = ["".join(rng.choice(parts)() for _ in range(rng.randint(0, 8))) for _ in range(500)]
    rows += ["&" + n for n in names]
    df = spark.createDataFrame([(r,) for r in rows], "s string")
    assert [r[0] for r in df.select(text.unescape_html("s")).collect()] == [html.unescape(r) for r in rows]


def test_html_is_unescaped_once(one):
    assert one(text.unescape_html("s"), "s string", "R&amp;D &lt;b&gt; &eacute; &amp;amp;") == "R&D <b> é &amp;"
    assert one(text.unescape_html("s"), "s string", "plain") == "plain"
    assert one(text.unescape_html("s"), "s string", None) is None


@pytest.mark.parametrize(
    "tags, cleaned", [([" Go ", "SQL"], ["go", "sql"]), ([], None), (None, None), (["A", None], ["a", None])]
)
def test_clean_tags(one, tags, cleaned):
    assert one(text.clean_tags("t"), "t array<string>", tags) == cleaned


def test_labels(one):
    label = text.label_with_fallback("s")
    got = [one(label, "s string", s) for s in ["bi", "ml", "devops", "language", "ci/cd", None]]
    assert got == ["BI", "ML", "DevOps", "Language", "Ci/Cd", None]


def test_percentages_are_exact(one):
    def pct(n, t, digits):
        return one(numbers.percentage(F.col("n"), F.col("t"), digits), "n long, t long", n, t)

    assert pct(29, 20000, 2) == Decimal("0.15")
    assert pct(1, 3, 1) == Decimal("33.3")
    assert pct(0, 7, 2) == Decimal("0.00")
    assert pct(5, 0, 2) is None
    assert pct(10**11, 10**11, 2) == Decimal("100.00")


def test_sql_functions(spark):
    register_sql_functions(spark)
    row = spark.sql(
        "select clean_text(' a  b ') c, is_mojibake('Ã©') m, is_non_latin('東') n, "
        "null_if_mojibake('Ã©') z, surrogate_key(' A ') k, md5('a') a"
    ).first()
    assert (row.c, row.m, row.n, row.z, row.k) == ("a b", True, True, None, row.a)
