import random
import re

import pytest

from postlode.operators import tagging
from postlode.operators.tagging import region_rows, tag

WORDS = ["java", "javascript", "us", "usa", "russia", "ci/cd", "ci", "cd", "data", "lake", "warehouse",
         "data-lake", "für", "fürs", "Für", "é", "éus", "us-é", "K", "kafka", "go_lang", "go", "İus", "straße"]
KEYWORDS = ["java", "us", "usa", "ci/cd", "data lake", "data", "lake data", "für", "kafka", "go", "é", "cd ci"]


def brute_force(rows, taxonomy):
    """Whole-word search by hand. A letter a-z in a keyword stands for itself and its capital only."""

    def occurs(keyword, text):
        found = re.finditer(rf"(?<!\w){re.escape(keyword)}(?!\w)", text or "", re.I)
        return any(m.group().isascii() or not keyword.isascii() for m in found)

    return sorted(
        (key, label) for key, *texts in rows for label, keyword in taxonomy
        if any(occurs(keyword, t) for t in texts)
    )


def random_rows(n, seed):
    rng = random.Random(seed)
    separators = [" ", " ", ", ", "-", "\n", "/", ". ", " "]
    return [
        (i, "".join(rng.choice(WORDS) + rng.choice(separators) for _ in range(rng.randint(0, 12))),
         rng.choice([None, "java", "data", "LAKE data"]))
        for i in range(n)
    ]


@pytest.mark.parametrize("strategy", ["inline", "by word"])
def test_strategies_agree_with_brute_force(spark, monkeypatch, strategy):
    if strategy != "inline":
        monkeypatch.setattr(tagging, "INLINE_KEYWORDS", 2)
    rows = random_rows(300, seed=7)
    taxonomy = [(f"L{i}", k) for i, k in enumerate(KEYWORDS)]
    df = spark.createDataFrame(rows, "id int, a string, b string")
    tax = spark.createDataFrame(taxonomy, "label string, match_keyword string")
    got = tag(df, tax, text=["a", "b"], label="label", key="id")
    assert sorted(map(tuple, got.collect())) == brute_force(rows, taxonomy)


@pytest.mark.parametrize("strategy", ["inline", "by word"])
def test_regions_are_distinct_and_have_a_default(spark, monkeypatch, strategy):
    if strategy != "inline":
        monkeypatch.setattr(tagging, "INLINE_KEYWORDS", 2)
    regions = spark.createDataFrame(
        [("usa", "NA"), ("us", "NA"), ("emea", "EU"), ("emea", "AF"), ("new mexico", "NA"),
         ("mexico", "LA"), (None, "X")],
        "match_keyword string, region string",
    )
    rows = [
        (1, "USA, US"), (2, "EMEA"), (3, "New Mexico"), (4, "Russia"), (5, None), (6, "U.S."), (7, ""),
    ]
    df = spark.createDataFrame(rows, "job_id int, location string")
    got = sorted(map(tuple, region_rows(df, regions, default="none").collect()))
    assert got == [
        (1, "NA"), (2, "AF"), (2, "EU"), (3, "LA"), (3, "NA"), (4, "none"), (5, "none"), (6, "none"),
        (7, "none"),
    ]


@pytest.mark.parametrize("strategy", ["inline", "by word"])
@pytest.mark.parametrize("distinct", [True, False])
@pytest.mark.parametrize("default", ["U", None])
def test_null_and_repeated_keys_are_rows_of_their_own(spark, monkeypatch, strategy, distinct, default):
    if strategy != "inline":
        monkeypatch.setattr(tagging, "INLINE_KEYWORDS", 1)
    rows = [(None, "some sql"), ("b", "sql and query"), ("b", "no match"), ("b", "sql and query"), ("c", None), (None, "x")]
    df = spark.createDataFrame(rows, "job_id string, t string")
    tax = spark.createDataFrame([("SQL", "sql"), ("SQL", "query"), ("X", "y z")], "label string, match_keyword string")
    got = tag(df, tax, text=["t"], label="label", distinct=distinct, default=default)
    both = 1 if distinct else 2
    expected = [(None, "SQL")] + [("b", "SQL")] * 2 * both
    if default:
        expected += [("b", "U"), ("c", "U"), (None, "U")]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("strategy", ["inline", "by word"])
def test_words_of_other_scripts_and_combining_marks(spark, monkeypatch, strategy):
    if strategy != "inline":
        monkeypatch.setattr(tagging, "INLINE_KEYWORDS", 2)
    keywords = ["cafe\u0301", "cafe", "東京", "m", "الرباط مدينة"]
    tax = spark.createDataFrame([(k, k) for k in keywords], "label string, match_keyword string")
    rows = [(1, "un CAFE\u0301 noir"), (2, "cafe noir"), (3, "東京, Japan"), (4, "東京都"), (5, "m² or 5m"),
            (6, "في الرباط مدينة"), (7, "الرباط، مدينة")]
    df = spark.createDataFrame(rows, "job_id int, t string")
    got = sorted(map(tuple, tag(df, tax, text=["t"], label="label").collect()))
    assert got == [(1, "cafe\u0301"), (2, "cafe"), (3, "東京"), (5, "m"), (6, "الرباط مدينة")]


def test_title_is_not_searched_and_null_matches_nothing(spark):
    df = spark.createDataFrame(
        [(1, "sql", None, None), (2, "x", "<b>SQL</b>", None), (3, "x", None, ["sql", None])],
        "job_id int, title string, description string, tags array<string>",
    )
    tax = spark.createDataFrame([("SQL", "sql")], "label string, match_keyword string")
    got = tag(df, tax, text=["description", "tags"], label="label")
    assert sorted(r.job_id for r in got.collect()) == [2, 3]


@pytest.mark.parametrize("bad", ["c++", ".net", "", "  ", "a|b", "--", "a\nb"])
@pytest.mark.parametrize("inline", [True, False])
def test_pattern_characters_are_refused(spark, monkeypatch, bad, inline):
    if not inline:
        monkeypatch.setattr(tagging, "INLINE_KEYWORDS", 0)
    df = spark.createDataFrame([(1, "x")], "job_id int, t string")
    tax = spark.createDataFrame([("L", bad)], "label string, match_keyword string")
    with pytest.raises(ValueError):
        tag(df, tax, text=["t"], label="label")


def test_empty_taxonomy(spark):
    df = spark.createDataFrame([(1, "x")], "job_id int, location string")
    none = spark.createDataFrame([], "match_keyword string, region string")
    assert [tuple(r) for r in region_rows(df, none, default="none").collect()] == [(1, "none")]
    assert tag(df, none, text=["location"], label="region").count() == 0


def test_text_is_searched_once_and_nothing_is_shuffled(spark):
    df = spark.range(5).selectExpr("id as job_id", "cast(id as string) as t")
    tax = spark.createDataFrame([(f"L{i}", f"w{i}") for i in range(30)], "label string, match_keyword string")
    plan = tag(df, tax, text=["t"], label="label")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert plan.count("split(") == 1


@pytest.mark.parametrize("limit", ["LOOKUP_KEYWORDS", "LOOKUP_CHARACTERS"])
def test_a_taxonomy_beyond_a_task_is_joined_with_the_same_rows(spark, monkeypatch, limit):
    monkeypatch.setattr(tagging, "INLINE_KEYWORDS", 2)
    rows = random_rows(200, seed=11)
    taxonomy = [(f"L{i}", k) for i, k in enumerate(KEYWORDS)] + [("L1", "us"), ("L1", "us")]
    df = spark.createDataFrame(rows + rows[:50], "id int, a string, b string")
    tax = spark.createDataFrame(taxonomy, "label string, match_keyword string")

    def found(**options):
        return sorted(map(tuple, tag(df, tax, text=["a", "b"], label="label", key="id", **options).collect()))

    looked_up, regions = found(), found(distinct=True, default="none")
    assert looked_up == brute_force(rows + rows[:50], taxonomy)
    monkeypatch.setattr(tagging, limit, 1)
    assert (found(), found(distinct=True, default="none")) == (looked_up, regions)


def test_a_taxonomy_that_fits_a_task_shuffles_no_text(spark, monkeypatch, capsys):
    monkeypatch.setattr(tagging, "INLINE_KEYWORDS", 2)
    df = spark.createDataFrame(random_rows(20, seed=3), "id int, a string, b string")
    tax = spark.createDataFrame([(k, k) for k in KEYWORDS], "label string, match_keyword string")
    for distinct, default in ((False, None), (True, "none")):
        tag(df, tax, text=["a", "b"], label="label", key="id", distinct=distinct, default=default).explain()
        assert "Exchange" not in capsys.readouterr().out
