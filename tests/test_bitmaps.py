import random

from pyspark.sql import functions as F

from postlode.operators.bitmaps import bitmaps, distinct_counts


def days(spark, rows):
    return spark.createDataFrame(rows, "day int, skill string, id long")


def counts(spark, rows, active):
    parts = bitmaps(days(spark, rows), "id", "day", "skill")
    now = bitmaps(spark.createDataFrame([(i,) for i in active], "id long"), "id")
    return {r.skill: (r.active_n, r.all_n) for r in distinct_counts(parts, now, "skill").collect()}


def test_days_merge_to_the_distinct_counts_of_all_pairs(spark):
    dice = random.Random(5)
    ids = [0, 1, 32768, 32769, 65536, -1, -32768, 1 << 40] + [dice.randrange(200_000) for _ in range(300)]
    rows = [(dice.randrange(4), dice.choice("abc"), dice.choice(ids)) for _ in range(3000)]
    active = set(dice.sample(ids, 100))
    expected = {}
    for _, skill, i in rows:
        expected.setdefault(skill, set()).add(i)
    assert counts(spark, rows, active) == {s: (len(v & active), len(v)) for s, v in expected.items()}


def test_null_keys_null_ids_and_empty_sides(spark):
    rows = [(1, None, 7), (2, None, 7), (2, None, 8), (1, "a", None), (1, "b", 3)]
    assert counts(spark, rows, [7]) == {None: (1, 2), "b": (0, 1)}
    assert counts(spark, rows, []) == {None: (0, 2), "b": (0, 1)}
    assert counts(spark, [], [7]) == {}


def test_a_day_is_small_however_many_pairs_it_repeats(spark):
    pairs = spark.range(200_000).select(F.lit("a").alias("skill"), (F.col("id") % 5000 + 1).alias("id"))
    found = bitmaps(pairs, "id", "skill").collect()
    assert len(found) == 1 and len(found[0].bits) == 4096
