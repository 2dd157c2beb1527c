"""Text rules as column expressions."""

from __future__ import annotations

import html
import html.entities
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlode import fixed_values as fixed


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sql_text(value: str) -> str:
    """A text as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def text_array(values: Iterable[str]) -> Column:
    """A constant array, built in one call; a call per value would slow planning."""
    return F.expr(f"cast(array({', '.join(map(sql_text, values))}) as array<string>)")


def clean_text(c: Column | str) -> Column:
    """Runs of white space become one space; blank becomes NULL."""
    return F.nullif(F.trim(F.regexp_replace(_col(c), fixed.WHITESPACE + "+", " ")), F.lit(""))


def strip_trailing_separators(c: Column | str) -> Column:
    """Drop commas and white space at the end ("Curitiba, ")."""
    return F.regexp_replace(_col(c), fixed.TRAILING_SEPARATORS, "")


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(F.trim(_col(c)), F.lit(""))


def is_ascii(c: Column | str) -> Column:
    """True if every character takes one byte; no scan of the text is needed."""
    return F.octet_length(_col(c)) == F.length(_col(c))


def is_mojibake(c: Column | str) -> Column:
    """Has a UTF-8 lead byte followed by a continuation byte, both read as Latin-1."""
    return ~is_ascii(c) & _col(c).rlike(fixed.MOJIBAKE_SIGNATURE)


def null_if_mojibake(c: Column | str) -> Column:
    return F.when(~is_mojibake(c), _col(c))


def is_non_latin(c: Column | str) -> Column:
    """Non-ASCII text without a single letter A-Z."""
    return _col(c).rlike(fixed.NON_ASCII) & ~_col(c).rlike(fixed.LATIN_LETTER)


def surrogate_key(c: Column | str) -> Column:
    return F.md5(F.lower(F.trim(_col(c).cast("string"))))


def _decode_if_utf8(run: Column) -> Column:
    as_bytes = F.encode(run, "ISO-8859-1")
    return F.when(F.is_valid_utf8(as_bytes.cast("string")), as_bytes.cast("string")).otherwise(run)


def _repair_once(text: Column) -> Column:
    run_or_rest = F.lit(f"{fixed.LATIN1_RUN}|{fixed.LATIN1_RUN.replace('[', '[^', 1)}")
    pieces = F.regexp_extract_all(text, run_or_rest, F.lit(0))
    fixed_pieces = F.transform(
        pieces,
        lambda p: F.when(p.rlike("^" + fixed.LATIN1_RUN), _decode_if_utf8(p)).otherwise(p),
    )
    return F.array_join(fixed_pieces, "")


def repair_mojibake(c: Column | str) -> Column:
    """Undo UTF-8 text read as Latin-1, up to three layers deep.

    Each run of U+0080..U+00FF is judged alone, so clean accents beside a
    damaged word survive. A run can only decode if it holds the signature, so
    every other text takes the cheap path: a length test for ASCII, one pattern
    test for the rest. The fold keeps each layer's result as a bound value, so
    the passes add up instead of multiplying.
    """
    text = _col(c)
    passes = F.array(*[F.lit(i) for i in range(fixed.REPAIR_PASSES)])
    repaired = F.aggregate(
        passes,
        text,
        lambda acc, _: F.when(acc.rlike(fixed.MOJIBAKE_SIGNATURE), _repair_once(acc)).otherwise(acc),
    )
    return F.when(is_mojibake(text), repaired).otherwise(text)


# A reference: a number in decimal or hex, or up to 32 signs that may be a name.
_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
_LAST_CODE = 0x10FFFF


def _text_map(pairs: Mapping[str, str]) -> Column:
    """A constant map, built in one call."""
    rows = (f"{sql_text(k)}, {sql_text(v)}" for k, v in pairs.items())
    return F.expr(f"map({', '.join(rows)})")


def _reference_names() -> dict[str, dict[str, str]]:
    """HTML's names by first letter, with the semicolon where it is needed."""
    by_letter: dict[str, dict[str, str]] = {}
    for name, value in sorted(html.entities.html5.items()):
        by_letter.setdefault(name[0], {})[name] = value
    return by_letter


def _by_code(reference: Column) -> Column:
    """The character of a numeric reference, as HTML reads it."""
    is_hex = reference.rlike("^&#[xX]")
    digits = F.regexp_replace(reference, "^&#[xX]?0*|;$", "")
    # Eight digits and more are beyond the last code in either base.
    short = F.length(digits) < 8
    code = F.when(short, F.conv(F.when(digits == "", "0").otherwise(digits), 16, 10).cast("long"))
    code = F.when(is_hex, code).otherwise(F.when(short, F.coalesce(digits.try_cast("long"), F.lit(0))))
    # What HTML gives for codes that stand for no character of their own.
    odd = {
        n: html.unescape(f"&#{n};")
        for n in [*range(0x20), *range(0x7F, 0xA0), *range(0xFDD0, 0xFDF0)]
        + [p * 0x10000 + e for p in range(17) for e in (0xFFFE, 0xFFFF)]
        if html.unescape(f"&#{n};") != chr(n)
    }
    special = F.try_element_at(
        F.expr(f"map({', '.join(f'{n}L, {sql_text(v)}' for n, v in odd.items())})"), code
    )
    none = code.isNull() | (code > _LAST_CODE) | code.between(0xD800, 0xDFFF)
    plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return F.when(none, "\ufffd").otherwise(F.coalesce(special, plain))


def _by_name(reference: Column) -> Column:
    """The characters of a named reference; the longest known start of it, or the text itself."""
    names = _reference_names()
    tables = F.expr(
        "map(" + ", ".join(
            f"{sql_text(letter)}, map({', '.join(f'{sql_text(k)}, {sql_text(v)}' for k, v in rows.items())})"
            for letter, rows in names.items()
        ) + ")"
    )
    bare = {k: v for rows in names.values() for k, v in rows.items() if not k.endswith(";")}
    lengths = sorted({len(k) for k in bare}, reverse=True)
    name = F.substring(reference, 2, 64)
    whole = F.try_element_at(F.try_element_at(tables, F.substring(name, 1, 1)), name)
    starts = _text_map(bare)
    parts = [
        F.when(
            F.length(name) > n,
            F.concat(F.try_element_at(starts, F.substring(name, 1, n)), F.substring(name, n + 1, 64)),
        )
        for n in lengths
    ]
    return F.coalesce(whole, *parts, reference)


def unescape_html(c: Column | str) -> Column:
    """Decode HTML character references once (``&amp;amp;`` gives ``&amp;``).

    Texts without an ampersand are left as they are. The name tables are those of the HTML
    standard as Python lists them, read while the plan is built.
    """
    text = _col(c)
    parts = F.split(text, "&")

    def decoded(part: Column) -> Column:
        reference = F.regexp_extract(F.concat(F.lit("&"), part), f"^{_REFERENCE}", 0)
        return F.transform(F.array(reference), lambda r: _decoded_head(r, part))[0]

    behind = F.transform(F.slice(parts, 2, F.size(parts)), decoded)
    return F.when(text.contains("&"), F.concat(parts[0], F.array_join(behind, ""))).otherwise(text)


def _decoded_head(reference: Column, part: Column) -> Column:
    """The text behind an ampersand, with the reference that they begin decoded; the ampersand stays if there is none."""
    rest = F.substring(part, F.length(reference), F.length(part))
    character = F.when(reference.rlike("^&#"), _by_code(reference)).otherwise(_by_name(reference))
    return F.when(reference == "", F.concat(F.lit("&"), part)).otherwise(F.concat(character, rest))


def contains_any(c: Column | str, words: Iterable[str]) -> Column:
    """Plain substring test for any of the words.

    The text is bound to a lambda variable, so it is computed once per row
    wherever the test ends up; a filter would compute it once per word.
    """
    listed = text_array(words)
    return F.exists(
        F.array(_col(c)), lambda text: F.exists(listed, lambda word: F.contains(text, word))
    )


def clean_tags(c: Column | str) -> Column:
    """Lower-cased, trimmed elements. Missing and empty arrays are both NULL."""
    tags = _col(c)
    return F.when(F.size(tags) > 0, F.transform(tags, lambda t: F.lower(F.trim(t))))


def title_case(c: Column | str) -> Column:
    """Capital after every non-letter, lower case elsewhere ("ci/cd" gives "Ci/Cd")."""
    words = F.regexp_extract_all(_col(c), F.lit("\\p{L}+|\\P{L}+"), F.lit(0))
    return F.array_join(F.transform(words, F.initcap), "")


def label_with_fallback(
    c: Column | str, labels: Mapping[str, str] = fixed.CATEGORY_LABELS
) -> Column:
    """Display label from the map, else the code in title case."""
    code = _col(c)
    known = F.create_map(*[F.lit(v) for pair in labels.items() for v in pair])
    return F.coalesce(F.try_element_at(known, code), title_case(code))
