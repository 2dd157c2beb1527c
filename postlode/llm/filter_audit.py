"""What each filter removes in every order of the filters, by Lehmer ranks and difference arrays.

A document's mask says which filters it fails. In an order of the filters it goes at the step of the first one it
fails. All orders that begin with the same filters have consecutive lexicographic ranks, so the orders in which a
mask goes at a step are a few intervals of ranks: those that begin with filters outside the mask and go on with one
inside. Documents are counted per part and mask; a count is added where an interval begins and taken off where
it ends; sums over the ranks then give the removals of every order and step at once. The work behind the counts
depends on the filters and parts alone, not on the documents.

Edge cases: a null text is empty, a null part the empty string. Rows with a null id have no smaller id to repeat and are
repeated by none; rows that share id and text do not repeat each other. Several labels of an id: one that says 1 is
enough. An empty table has no parts and gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD_BREAK = r"[\x20\x09-\x0D]+"
MOST_FILTERS = 6  # 720 orders; the result has a row per part, order and step


def lehmer_rank(prefix: Sequence[int], n: int) -> int:
    """Rank of the first order of ``0..n-1`` that begins with ``prefix``."""
    unused, rank = list(range(n)), 0
    for place, item in enumerate(prefix):
        rank += unused.index(item) * factorial(n - 1 - place)
        unused.remove(item)
    return rank


def removal_intervals(n: int) -> Iterator[tuple[int, int, int, int]]:
    """``mask, step, low, high``: orders with these ranks, high excluded, remove the mask at the step (from 1)."""
    for mask in range(1, 1 << n):
        passed = [i for i in range(n) if not mask >> i & 1]
        failed = [i for i in range(n) if mask >> i & 1]
        for before in range(len(passed) + 1):
            for prefix in permutations(passed, before):
                for item in failed:
                    low = lehmer_rank((*prefix, item), n)
                    yield mask, before + 1, low, low + factorial(n - before - 1)


def _literal(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(pa.table({k: list(c) for k, c in zip(names, zip(*rows, strict=True), strict=True)}))


def audit(masks: DataFrame, filters: Sequence[str], watched: Sequence[str] = ()) -> DataFrame:
    """Per part, order and step what the step's filter keeps and removes.

    ``masks`` has ``part``, ``mask`` (bit ``i`` set: the row fails ``filters[i]``; filters are in ascending order)
    and a boolean column for each name in ``watched``; ``<name>_lost`` counts such rows among the removed.
    """
    n = len(filters)
    if not 0 < n <= MOST_FILTERS or list(filters) != sorted(set(filters)) or any(len(f) != 1 for f in filters):
        raise ValueError(f"one to {MOST_FILTERS} filters, single letters in ascending order")
    spark = masks.sparkSession
    lost = [f"{w}_lost" for w in watched]
    counts = masks.groupBy("part", "mask").agg(
        F.count("*").alias("removed"), *[F.count_if(F.col(w)).alias(x) for w, x in zip(watched, lost, strict=True)]
    )
    # Interval ends, one table of a size that the number of filters fixes.
    intervals = _literal(spark, ["mask", "step", "low", "high"], list(removal_intervals(n)))
    added = counts.join(F.broadcast(intervals), "mask")
    ends = added.select(
        "part", "step",
        F.explode(F.array(
            F.struct(F.col("low").alias("rank"), *[F.col(c) for c in ("removed", *lost)]),
            F.struct(F.col("high").alias("rank"), *[(-F.col(c)).alias(c) for c in ("removed", *lost)]),
        )).alias("end"),
    )
    differences = ends.groupBy("part", "step", F.col("end.rank").alias("rank")).agg(
        *[F.sum(f"end.{c}").alias(c) for c in ("removed", *lost)]
    )
    # Every order and step of every part, with the part's own counts.
    fails = [F.sum(F.when(F.col("mask").bitwiseAND(1 << i) != 0, F.col("removed"))) for i in range(n)]
    alone = [F.sum(F.when(F.col("mask") == 1 << i, F.col("removed"))) for i in range(n)]
    parts = counts.groupBy("part").agg(
        F.sum("removed").alias("total"),
        F.array(*[F.coalesce(f, F.lit(0)) for f in fails]).alias("fails"),
        F.array(*[F.coalesce(f, F.lit(0)) for f in alone]).alias("alone"),
    )
    orders = _literal(spark, ["rank", "filter_order"], [
        (rank, "".join(order)) for rank, order in enumerate(permutations(filters))
    ])
    last = factorial(n) - 1
    grid = parts.select("*", F.explode(F.expr(f"sequence(0L, {last}L)")).alias("rank")).select(
        "*", F.explode(F.expr(f"sequence(1L, {n}L)")).alias("step")
    )
    up_to = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    summed = (
        grid.join(differences, ["part", "step", "rank"], "left")
        .select("part", "step", "rank", "total", "fails", "alone",
                *[F.coalesce(F.sum(c).over(up_to), F.lit(0)).alias(c) for c in ("removed", *lost)])
        .join(F.broadcast(orders), "rank")
    )
    letter = F.substring("filter_order", F.col("step").cast("int"), F.lit(1))
    place = F.array_position(F.array(*[F.lit(f) for f in filters]), letter).cast("int")
    so_far = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    same = Window.partitionBy("part", "letter")
    return summed.withColumn("letter", letter).select(
        "part", "filter_order", F.col("step").cast("int").alias("step"),
        (F.col("total") - F.sum("removed").over(so_far)).alias("kept"),
        "removed",
        (F.element_at("fails", place) - F.col("removed")).alias("redundant"),
        F.element_at("alone", place).alias("unique_fails"),
        *lost,
        F.sum("removed").over(same).alias("shapley"),
    )


def masked(
    documents: DataFrame, rules: Sequence[Column], labels: DataFrame, part: str, watched: dict[str, Column]
) -> DataFrame:
    """``part, mask`` and the watched booleans of every document.

    ``rules`` are conditions over ``text`` (null as empty) and its ``words``; a true one fails the document.
    The bit after theirs stands for a text that a smaller id has too. ``watched`` are conditions over ``labels``.
    """
    text = F.coalesce("text", F.lit(""))
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part), F.lit("")).alias("part"),
        text.alias("text"),
    ).withColumn("words", F.array_remove(F.split("text", WORD_BREAK), ""))
    bits = [F.when(rule, 1 << i).otherwise(0) for i, rule in enumerate(rules)]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask + bit
    flagged = texts.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.alias("mask"))
    first = flagged.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.lit(True).alias("first"))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        *[F.coalesce(F.bool_or(rule), F.lit(False)).alias(name) for name, rule in watched.items()]
    )
    # Both keys together: copies of one text fall on as many keys as they have ids.
    joined = flagged.join(first.where("doc_id is not null"), ["doc_id", "digest"], "left").join(marks, "doc_id", "left")
    repeated = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return joined.select(
        "part", (F.col("mask") + F.when(repeated, 1 << len(rules)).otherwise(0)).alias("mask"),
        *[F.coalesce(name, F.lit(False)).alias(name) for name in watched],
    )


FILTERS = "ABCDE"


def few_words() -> Column:
    return F.size("words") < 200


def repetitive() -> Column:
    """Fewer distinct words than half of all."""
    return 100 * F.size(F.array_distinct("words")) < 50 * F.size("words")


def capitals() -> Column:
    """More than three code points of a hundred are A-Z."""
    return 100 * F.regexp_count("text", F.lit("[A-Z]")) > 3 * F.length("text")


def symbols() -> Column:
    return F.col("text").rlike(r"[#$%&*|]")


def audit_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters A to E by ``lang``, with what is lost of labels ``quality`` 1 and ``toxic`` 1."""
    watched = {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1}
    rules = [few_words(), repetitive(), capitals(), symbols()]
    return audit(masked(documents, rules, labels, "lang", watched), FILTERS, list(watched))
