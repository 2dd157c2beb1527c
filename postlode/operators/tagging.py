"""Tag rows with the labels whose keyword occurs in their text as a whole word.

A keyword matches at Unicode word boundaries, any case, in any of the given
text columns. Every (row, label) pair of the whole table is found. A short taxonomy
is written into the plan, one that fits a task is looked up there word by word, and a longer
one is joined by words; all give each row its list of labels, and what follows is the same.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from postlode.functions.text import is_ascii, sql_text, text_array

# Up to this many keywords are written into the plan as literals.
INLINE_KEYWORDS = 200
# Up to this many keywords, of so many characters with their labels, are sent to every task.
LOOKUP_KEYWORDS, LOOKUP_CHARACTERS = 100_000, 8_000_000
# Copies of each keyword in a shuffled join on words.
WORD_SALTS = 16

_METACHARACTERS = re.compile(r"[\\^$.|?*+()\[\]{}]")
# Fields are searched as one text. Keywords hold no line break, so none can
# match across two fields, and a field's edge stays a word boundary.
_FIELD_BREAK = "\n"
_NOT_WORD = "(?U)\\W+"


def _is_word(c: str) -> bool:
    """The characters of the JVM's Unicode ``\\w``; Python's leaves out combining marks."""
    kind = unicodedata.category(c)
    return kind[0] in "LM" or kind in ("Nd", "Nl", "Pc") or c in "\u200c\u200d"


def _words_of(keyword: str) -> list[str]:
    runs = itertools.groupby(keyword.lower(), _is_word)
    return ["".join(run) for is_word, run in runs if is_word]


def check_keyword(keyword: str) -> str:
    """Keywords go into patterns as they are, so they must be plain words."""
    if _METACHARACTERS.search(keyword) or _FIELD_BREAK in keyword or not _words_of(keyword):
        raise ValueError(f"keyword {keyword!r} is blank or holds a pattern character")
    return keyword


def word_pattern(keywords: Sequence[str]) -> str:
    """Any of the keywords as a whole word. Case is folded within the keyword's alphabet."""
    fold = "i" if all(k.isascii() for k in keywords) else "iu"
    return f"(?U:\\b)(?{fold}:{'|'.join(keywords)})(?U:\\b)"


# The one character whose lower case is a letter a-z: texts that hold it are
# always checked with the pattern, which folds ASCII letters only.
_KELVIN = "\u212a"


def _searchable(df: DataFrame, text: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The given columns with the row's text: ``_text``, ``_lower`` and the ``_odd`` flag."""
    whole = F.concat_ws(_FIELD_BREAK, *[F.col(c) for c in text])
    texts = df.select(*columns, whole.alias("_text"))
    return texts.withColumns(
        {"_lower": F.lower("_text"), "_odd": F.contains("_text", F.lit(_KELVIN))}
    )


def _words_in(lower: Column | str) -> Column:
    return F.split(lower, _NOT_WORD, -1)


def _hit(keywords: list[str]) -> str:
    """SQL test for any of the keywords, given the taxonomy's words ``_found`` in the row.

    A keyword that is one word needs no more than that. A compound one is looked
    for in the text once all of its words are there.
    """

    def occurs(keyword: str) -> str:
        words = _words_of(keyword)
        found = [f"array_contains(_found, {sql_text(w)})" for w in dict.fromkeys(words)]
        matched = f"_text RLIKE {sql_text(word_pattern([keyword]))}"
        if words == [keyword.lower()]:
            return f"({found[0]} AND (NOT _odd OR {matched}))"
        contained = f"contains(_lower, {sql_text(keyword.lower())})"
        return f"({' AND '.join([*found, contained, matched])})"

    return " OR ".join(map(occurs, keywords))


def _labelled_rows(
    labelled: DataFrame, label: str, carry: Sequence[str], distinct: bool, default: str | None
) -> DataFrame:
    """A row per label of ``_labels``; rows with none get the default, if there is one."""
    labels = F.array_distinct("_labels") if distinct else F.col("_labels")
    if default is not None:
        labels = F.when(F.size("_labels") == 0, F.array(F.lit(default))).otherwise(labels)
    # A plain explode makes Catalyst infer a filter on the array's size, which it
    # pushes down to the scan with every expression above written out in it: the
    # whole search would run once more per keyword. The outer form infers none.
    return labelled.select(*carry, F.explode_outer(labels).alias(label)).where(F.col(label).isNotNull())


def _tag_inline(
    df: DataFrame, groups: list[tuple[str, list[str]]], text: Sequence[str], carry: Sequence[str]
) -> DataFrame:
    """One pass, no shuffle: the row's labels by the taxonomy's words found in it.

    The row's words are hashed against those of the whole taxonomy at once, so
    the cost of a text hardly depends on the number of keywords.
    """
    taxonomy_words = dict.fromkeys(w for _, kws in groups for k in kws for w in _words_of(k))
    found = F.array_intersect(_words_in("_lower"), text_array(taxonomy_words))
    texts = _searchable(df, text, carry).withColumn("_found", found)
    # Written as SQL text: thousands of column calls would take longer than small jobs do.
    tests = [f"CASE WHEN {_hit(kws)} THEN {sql_text(name)} END" for name, kws in groups]
    labels = F.array_compact(F.expr(f"array({', '.join(tests)})"))
    return texts.select(*carry, labels.alias("_labels"))


def _first_words(taxonomy: DataFrame) -> DataFrame:
    """``_word, label, plain, pattern`` of every keyword.

    The first word in a keyword is a whole word wherever the keyword matches,
    so no match is lost; keywords of more than one word, or with other signs,
    are then checked against the text.
    """
    keyword_words = F.trim(F.regexp_replace(F.lower("_keyword"), _NOT_WORD, " "))
    fold = F.when(is_ascii("_keyword"), F.lit("i")).otherwise(F.lit("iu"))
    plain = (keyword_words == F.lower("_keyword")) & (F.instr(keyword_words, F.lit(" ")) == 0)
    pattern = F.concat(F.lit("(?U:\\b)(?"), fold, F.lit(":"), F.col("_keyword"), F.lit(")(?U:\\b)"))
    return taxonomy.select(
        F.substring_index(keyword_words, " ", 1).alias("_word"),
        F.col("_label").alias("label"), plain.alias("plain"), pattern.alias("pattern"),
    )


def _fits_a_task(taxonomy: DataFrame) -> bool:
    size = taxonomy.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("_keyword") + F.length("_label")).alias("characters")
    ).first()
    return size.n <= LOOKUP_KEYWORDS and size.characters <= LOOKUP_CHARACTERS


def _lookup(keywords: list[Row]):
    """A row's candidates by its words; the pattern is null where the word alone is a match."""
    keywords = sorted(keywords, key=lambda k: k["_word"])
    first = [i for i, k in enumerate(keywords) if not i or keywords[i - 1]["_word"] != k["_word"]]
    known = pa.array([keywords[i]["_word"] for i in first], pa.string())
    begins, counts = np.array(first), np.diff([*first, len(keywords)])
    labels = pa.array([k["label"] for k in keywords], pa.string())
    patterns = pa.array([k["pattern"] for k in keywords], pa.string())
    plain = np.array([k["plain"] for k in keywords], bool)

    @F.arrow_udf("array<struct<label: string, pattern: string>>")
    def candidates(words: pa.Array, odd: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
        codes = pc.fill_null(pc.index_in(words.flatten(), value_set=known), -1).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(words)), sizes)[codes >= 0]
        codes = codes[codes >= 0]
        n = counts[codes]
        at = np.repeat(begins[codes] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        row = np.repeat(row, n)
        sure = plain[at] & ~pc.fill_null(odd, False).to_numpy(zero_copy_only=False)[row]
        found = pa.StructArray.from_arrays(
            [labels.take(pa.array(at)), patterns.take(pa.array(at, mask=sure))], ["label", "pattern"]
        )
        offsets = np.searchsorted(row, np.arange(len(words) + 1))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), found)

    return candidates


def _tag_by_lookup(
    df: DataFrame, taxonomy: DataFrame, text: Sequence[str], carry: Sequence[str]
) -> DataFrame:
    """One pass, no shuffle: the distinct words of each text are looked up among the keywords' first words."""
    candidates = _lookup(_first_words(taxonomy).collect())
    texts = _searchable(df, text, carry)
    found = texts.select(*carry, "_text", candidates(F.array_distinct(_words_in("_lower")), "_odd").alias("_candidates"))
    matched = F.filter("_candidates", lambda c: c["pattern"].isNull() | F.regexp_like(F.col("_text"), c["pattern"]))
    return found.select(*carry, F.transform(matched, lambda c: c["label"]).alias("_labels"))


def _tag_by_word(
    df: DataFrame, taxonomy: DataFrame, text: Sequence[str], carry: Sequence[str]
) -> DataFrame:
    """Equi-join the distinct words of each text to the first word of each keyword.

    A text's candidates depend on nothing but the text, so they
    come back by its digest: equal texts are searched once, and rows need no key.
    """
    # A word may occur in most texts: they are spread over salted copies of its keywords.
    salts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(WORD_SALTS - 1).cast("bigint")))
    keywords = _first_words(taxonomy).select(
        "_word", F.struct("label", "plain", "pattern").alias("_candidate"), salts.alias("_salt")
    )
    texts = _searchable(df, text, carry).withColumn("_text_id", F.unhex(F.md5("_text")))
    words = F.explode_outer(F.array_distinct(_words_in("_lower"))).alias("_word")
    salt = F.pmod(F.xxhash64("_text_id"), F.lit(WORD_SALTS)).alias("_salt")
    candidates = (
        texts.select("_text_id", salt, words)
        .distinct()
        .join(keywords, ["_word", "_salt"])
        .groupBy("_text_id")
        .agg(F.collect_list("_candidate").alias("_candidates"))
    )
    matched = F.filter(
        F.coalesce("_candidates", F.array().cast(candidates.schema["_candidates"].dataType)),
        lambda c: (c["plain"] & ~F.col("_odd")) | F.regexp_like(F.col("_text"), c["pattern"]),
    )
    return texts.join(candidates, "_text_id", "left").select(
        *carry, F.transform(matched, lambda c: c["label"]).alias("_labels")
    )


def tag(
    df: DataFrame,
    taxonomy: DataFrame,
    *,
    text: Sequence[str],
    label: str,
    keyword: str = "match_keyword",
    key: str = "job_id",
    carry: Sequence[str] = (),
    distinct: bool = False,
    default: str | None = None,
) -> DataFrame:
    """``(key, *carry, label)`` for every taxonomy row whose keyword occurs in ``text``.

    ``text`` names string or string-array columns. ``distinct`` gives each label
    once per row however many of its keywords occur. ``default`` is the label of
    rows that match nothing; without it they are absent. ``key`` is carried
    along: each row is tagged by itself, whether its key is NULL or repeated.
    """
    carried = [key, *carry]
    named = F.coalesce(
        F.col(label).cast("string"), F.raise_error(F.lit(f"taxonomy row without {label}")).cast("string")
    )
    rows = taxonomy.select(named.alias("_label"), F.col(keyword).alias("_keyword")).where(
        "_keyword IS NOT NULL"
    )
    head = rows.limit(INLINE_KEYWORDS + 1).collect()
    if len(head) > INLINE_KEYWORDS:
        bad = rows.where(
            F.col("_keyword").rlike(_METACHARACTERS.pattern)
            | F.col("_keyword").contains(_FIELD_BREAK)
            | ~F.col("_keyword").rlike("(?U)\\w")
        ).head(1)
        for row in bad:
            check_keyword(row["_keyword"])
        search = _tag_by_lookup if _fits_a_task(rows) else _tag_by_word
        labelled = search(df, rows, text, carried)
    elif head:
        groups = [(row["_label"], [check_keyword(row["_keyword"])]) for row in head]
        if distinct:
            by_label: dict[str, list[str]] = {}
            for name, keywords in groups:
                by_label.setdefault(name, []).extend(keywords)
            groups = list(by_label.items())
        labelled = _tag_inline(df, groups, text, carried)
    else:
        labelled = df.select(*carried, F.array().cast("array<string>").alias("_labels"))
    return _labelled_rows(labelled, label, carried, distinct, default)


def region_rows(
    fact: DataFrame, regions: DataFrame, *, key: str = "job_id", location: str = "location",
    carry: Sequence[str] = (), default: str,
) -> DataFrame:
    """Each row's hiring regions, or the default region if its location names none."""
    return tag(
        fact, regions, text=[location], label="region", key=key, carry=carry,
        distinct=True, default=default,
    )
